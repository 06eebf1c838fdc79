"""End-to-end pipelines and the named-query registry."""
