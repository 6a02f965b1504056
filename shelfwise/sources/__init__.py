"""Sources: the given parquet tables, the star views over them, raw-string
fixtures, the CSV scan and the staging of stream files."""

from .tables import Tables, load_tables
from .star import Star, build_star

__all__ = ["Tables", "load_tables", "Star", "build_star"]
