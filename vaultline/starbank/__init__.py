"""A bank derived from the star-schema tables, so that every operator runs over given data."""
