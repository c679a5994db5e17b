"""All named queries, grouped as the inventory groups them."""

from tiffin.catalog import aggregates, columns, messages, models, scalars, streams  # noqa: F401
from tiffin.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
