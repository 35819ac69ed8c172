"""Raw files, the lake, JDBC, the curated store, publication and the run log."""
