"""Plans: the pipeline and the catalog of queries."""
