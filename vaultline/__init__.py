"""Bank data curation, marts and reporting as Spark DataFrame plans."""
