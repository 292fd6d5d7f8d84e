"""Entity resolution, enrichment and ranking on Spark DataFrames."""
