"""Plans: serving queries, pipeline composition and the query registry."""
