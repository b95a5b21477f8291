"""Whole queries: marts, the serving queries on them, the landing job."""

from .landing import lake_ledger, land_period, read_lake, read_rejects, reconcile, vacuum_lake
from .marts import (
    best_language_counts, country_pair_tone, country_tone, event_mentions, event_rollup, item_tones, mart_counts,
    monthly_from_states, monthly_pairs, of_kind, pair_state, person_tone, theme_tone,
)
from .rollups import read_monthly, refresh_monthly
from .serving import (
    country_series, day_slice, events_per_day, events_sorted, monthly_leaders, ranked, ranked_from_second,
    rows_of_country, rows_of_item, rows_of_pair, watchlist_grid,
)

__all__ = [
    "best_language_counts", "country_pair_tone", "country_series", "country_tone", "day_slice", "event_mentions",
    "event_rollup", "events_per_day", "events_sorted", "item_tones", "lake_ledger", "land_period", "mart_counts", "monthly_from_states", "monthly_leaders",
    "monthly_pairs", "of_kind", "pair_state", "person_tone", "ranked", "ranked_from_second", "read_lake", "read_monthly", "read_rejects", "reconcile", "refresh_monthly", "rows_of_country", "rows_of_item",
    "rows_of_pair", "theme_tone", "vacuum_lake", "watchlist_grid",
]
