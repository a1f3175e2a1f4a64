"""Table-to-table operators: assembly, enrichment and the parse jobs."""
