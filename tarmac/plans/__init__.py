"""SQL texts, ML pipelines and the catalog of named queries with their oracles."""
