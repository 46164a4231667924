"""All driver queries, merged from the per-area modules."""

from tickmart.plans.queries import (  # noqa: F401
    history, incremental, job, marts, quality, shaping, sinks, streams,
)
from tickmart.plans.queries.registry import ORACLES, QUERIES  # noqa: F401

# Queries that only read (the others write scratch tables, run streams or jobs).
READ_ONLY = [
    "flagship_daily_fact", "ohlc_bars", "close_sibling_series", "epoch_to_utc_date",
    "prev_value_lag", "moving_avg_7", "daily_change_pct", "rank_gainers", "rank_losers",
    "market_summary", "category_metrics", "asset_dimension", "first_seen", "high_water",
    "series_unnest_positional", "standardise_snapshot", "struct_flatten", "bridge_explode",
    "universe_semi", "missing_assets_anti", "distinct_on_key", "keep_first", "top_n_by_cap",
    "dq_unique", "dq_not_null", "dq_unique_combo", "dq_relationships", "dq_non_negative",
    "dq_report", "dq_freshness",
]
