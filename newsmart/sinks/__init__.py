"""Mart sinks."""

from .marts import to_mart_schema, write_frame, write_mart, write_period
from .merge import merge_mart

__all__ = ["merge_mart", "to_mart_schema", "write_frame", "write_mart", "write_period"]
