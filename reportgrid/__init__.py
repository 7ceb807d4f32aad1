"""reportgrid: raw report grids to one typed, enriched fact table, as Spark jobs."""
