"""shelfwise: a retail star-schema warehouse written with Spark DataFrames.

Raw order lines and product master data are cleansed, conformed into
dimensions with first-wins deduplication and dense surrogate keys, joined into
a sales fact (batch or Structured Streaming), and queried with OLAP operators
(drill-down, rollup / grouping sets, slice and dice, quarter pivot, top-k,
sigma anomaly) and refreshable aggregate tables.
"""

__all__ = ["session", "schemas", "params"]
