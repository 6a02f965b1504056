"""Structured Streaming jobs: micro-batch ingest, enrichment to the fact,
first-wins dimension append, incremental aggregate refresh, rate report."""
