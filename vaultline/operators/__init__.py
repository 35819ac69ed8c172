"""Data-quality rules, key probes, curation, audits and quality reports."""
