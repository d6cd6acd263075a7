"""Reading the input tables, deriving the mart's source tables, writing outputs."""

from parcelmart.sources.tables import TABLE_NAMES, load, register_views
from parcelmart.sources.sinks import publish, published, write_table

__all__ = ["TABLE_NAMES", "load", "register_views", "write_table", "publish", "published"]
