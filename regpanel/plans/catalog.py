"""Imports every catalogue module so the registry is complete."""

from regpanel.plans import (catalog_cells, catalog_composite, catalog_io, catalog_joins, catalog_shape,  # noqa: F401
                            catalog_stats, catalog_text, catalog_whole)
from regpanel.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
