"""Plans: the user-facing jobs (ten OLAP queries, ingest, dimensions, fact
loads, quality checks, aggregate tables) written over star DataFrames."""
