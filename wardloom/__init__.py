"""Research extracts from hospital warehouse tables, as plain Spark plans."""

from wardloom.params import Params
from wardloom.sources.catalog import Catalog

__all__ = ["Catalog", "Params"]
