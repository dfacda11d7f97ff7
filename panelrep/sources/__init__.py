"""Sources (bridges, fact tables, ingest) and sinks (template, study subsets)."""
