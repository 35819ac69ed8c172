"""Marts, analytics queries and read operations over the curated tables."""
