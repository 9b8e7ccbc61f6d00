"""Readers and writers: CSV, relational tables, API pages, the parquet lake and the warehouse."""

from cinelake.sources.csvfiles import read_positional_csv
from cinelake.sources.declared import declared_types, from_declared, to_declared
from cinelake.sources.lake import Lake, Profile
from cinelake.sources.pages import LandedPages, land_pages, page_results, read_pages, snapshot
from cinelake.sources.relational import (
    cut_points, cut_points_query, cut_predicates, extract_year, extract_years, jdbc_options, key_range_options, read_query,
    read_split, read_table, read_years, year_predicates,
)
from cinelake.sources.warehouse import (
    CatalogWarehouse, JdbcWarehouse, ParquetWarehouse, Warehouse, as_table, as_view, publish,
)

__all__ = [
    "CatalogWarehouse", "JdbcWarehouse", "Lake", "LandedPages", "ParquetWarehouse", "Profile", "Warehouse",
    "as_table", "as_view", "cut_points", "cut_points_query", "cut_predicates", "declared_types", "from_declared", "read_split", "to_declared", "extract_year", "extract_years", "jdbc_options", "key_range_options", "land_pages", "page_results", "publish", "read_pages",
    "read_positional_csv", "read_query", "read_table", "read_years", "snapshot",
    "year_predicates",
]
