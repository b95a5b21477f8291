"""Relational building blocks: DataFrames in, DataFrames out."""

from .filters import exclude_pairs, keep_watchlist, pair_members
from .grid import month_grid
from .keys import collapse_to_key, repeat_rows
from .mentions import best_mention, tallied_events
from .once import once
from .records import (
    parse_events, parse_gkg, parse_mentions, reject_reason, rejected_lines, with_field_count,
)
from .tones import explode_pairs, tone_by_item, tones_by_kind
from .toprows import without_top_row

__all__ = [
    "best_mention", "collapse_to_key", "exclude_pairs", "explode_pairs",
    "keep_watchlist", "month_grid", "once", "pair_members", "parse_events", "parse_gkg", "parse_mentions", "reject_reason", "rejected_lines",
    "repeat_rows", "tallied_events",
    "tone_by_item", "tones_by_kind", "with_field_count", "without_top_row",
]
