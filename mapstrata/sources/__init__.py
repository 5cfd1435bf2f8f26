"""Readers of microdata, metadata, catalogues, scale tables and translation dictionaries."""

from mapstrata.sources.tables import (
    read_bin_table,
    read_catalogs,
    read_long_scale,
    read_metadata,
    read_microdata,
    read_scale,
    read_translations,
    staged_scale,
)

__all__ = [
    "read_bin_table",
    "read_catalogs",
    "read_long_scale",
    "read_metadata",
    "read_microdata",
    "read_scale",
    "read_translations",
    "staged_scale",
]
