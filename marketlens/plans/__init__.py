"""Plans: the catalogue pipeline, the market study, and their binding to tables."""
