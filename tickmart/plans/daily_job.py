"""JOB-1: the daily run as one Spark application.

landing/ (payloads as landed)        warehouse/
  universe/   comma-separated ids      raw/coin_markets, raw/coin_price_history,
  markets/    snapshot lists, one      raw/coins_categories
              response per file        staging/..., intermediate/..., marts/...,
  market_lines/ the same, one          snapshots/dim_coins_snapshot, audit/...
              response per line
  charts/     chart payloads
  categories/ category payloads
              (*.json: one response a file, others JSON Lines)

Order: the three loads (independent, run as concurrent Spark jobs), then the
models in dependency order, then the SCD2 snapshot, then every quality check
and the source freshness; an error-severity failure raises after the report
is written.  Every table
is written as a new committed version and read back before the next step
uses it, so each stage restarts from stored data (not lineage) when an
executor is lost, and a failed run leaves the previous versions current.
A run without any market or any chart row fails, as does one with a source past
its error age; values and payloads that don't fit (``rejected_input``) and universe assets
without a chart are reported in the audit layer.
"""

from __future__ import annotations

import contextvars
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.fixed import (
    DEFAULT_CHART_DAYS, DEFAULT_UNIVERSE, FACT_COLUMNS, FRESHNESS_HOURS, LAYERS, PRICE_SCALE,
)
from tickmart.operators import quality as Q
from tickmart.operators.dedupe import missing_keys
from tickmart.operators.fingerprint import fingerprint
from tickmart.operators.ledger import LedgerTable, QualityLedger
from tickmart.operators.metrics import METRIC_COLUMNS
from tickmart.operators.standardise import standardise_categories, standardise_snapshot
from tickmart.plans import models as M
from tickmart.plans.asset_state import read_state
from tickmart.plans.incremental import SeriesTables, run_increment
from tickmart.session import close_run_scratch, configure, open_run_scratch
from tickmart.sinks.load import LoadReport, load
from tickmart.sinks.history import merge_history, read_history
from tickmart.sinks.partitioned import (
    NO_DATE, Months, follow_months, live_months, partitioned_exists, read_partitioned, vacuum_partitioned,
)
from tickmart.sinks.tables import _fs, layer_path, publish, read_table, stage, table_exists, vacuum
from tickmart.sinks.upsert import latest_per_key
from tickmart.sources.payloads import (
    accepted_charts, accepted_snapshots, category_rows, file_stem, parse_charts, parse_snapshots, read_keyed_payloads,
    read_snapshot_payloads, rejects,
)
from tickmart.schemas import RAW_CATEGORIES, RAW_SERIES
from tickmart.sources.universe import parse_universe, restrict_to_universe



@dataclass
class JobConfig:
    landing: str
    warehouse: str
    batch_ts: str  # lineage stamp of this run's loads
    as_of: str  # the run's "now" (defaults for missing dates, freshness)
    chart_days: int = DEFAULT_CHART_DAYS
    price_scale: int = PRICE_SCALE
    full_refresh: bool = False
    fail_on_error: bool = True
    # Skip rebuilding a stored bar from the partial first day of a re-sent window.
    protect_boundary: bool = False
    # Categories: per (asset, category) upsert (source behaviour, vanished
    # categories stay) or replace every category of an asset present in the load.
    replace_categories_per_asset: bool = False
    # Committed versions kept per versioned table after a successful run.
    keep_versions: int = 3
    # Go on with the stored rows when no market or no chart row came.
    allow_empty: bool = False


class EmptyLoadError(RuntimeError):
    """A load that the run needs brought no row."""


@dataclass
class JobResult:
    loads: dict[str, LoadReport] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)


def table_path(cfg: JobConfig, name: str) -> str:
    return layer_path(cfg.warehouse, name, custom_schema=LAYERS[name])


def model_checks() -> list[Q.Check]:
    """The source project's model tests (plus the two it never ran)."""
    C, W = Q.Check, Q.WARN

    def nn(t, *cs):
        return [C(t, "not_null", (c,)) for c in cs]

    return [
        C("stg_coin_markets", "unique", ("name_id",)), *nn("stg_coin_markets", "name_id"),
        C("stg_coin_markets", "not_null", ("symbol_name",), W),
        *nn("stg_coin_markets", "last_updated", "ingested_at"),
        C("stg_coin_price_history", "unique_combination", ("coin_id", "coin_date")),
        *nn("stg_coin_price_history", "coin_id", "coin_date", "high_price", "low_price",
            "close_price", "close_market_cap", "close_total_volume"),
        C("int_coin_daily_metrics", "unique_combination", ("coin_id", "date_stamp")),
        *nn("int_coin_daily_metrics", "coin_id"),
        C("int_coin_daily_metrics", "relationships", ("coin_id",),
          parent="stg_coin_price_history", parent_column="coin_id"),
        *nn("int_coin_daily_metrics", "date_stamp", "close_price", "high_price", "low_price",
            "close_market_cap"),
        C("int_coin_daily_metrics", "non_negative", ("close_market_cap",)),
        *nn("int_coin_daily_metrics", "close_total_volume"),
        C("int_coin_daily_metrics", "not_null", ("daily_price_change_pcg",), W),
        *nn("int_coin_daily_metrics", "moving_avg_7d"),
        *nn("int_coin_categories", "coin_id", "category"),
        C("int_coin_categories", "relationships", ("coin_id",),
          parent="stg_coin_markets", parent_column="name_id"),
        C("dim_coins", "unique_combination", ("coin_id", "category")),
        *nn("dim_coins", "coin_id", "category", "first_seen_date"),
        C("dim_coins", "relationships", ("coin_id",), parent="stg_coin_markets",
          parent_column="name_id"),
        C("fct_daily_coin_performance", "unique_combination", ("coin_id", "trade_date")),
        *nn("fct_daily_coin_performance", "coin_id", "trade_date", "close_price_usd",
            "high_price_usd", "low_price_usd", "volume", "market_cap", "daily_price_change_pct",
            "moving_avg_7d_price"),
        C("fct_daily_coin_performance", "relationships", ("coin_id",),
          parent="int_coin_daily_metrics", parent_column="coin_id"),
        C("fct_daily_coin_performance", "non_negative", ("market_cap",)),
        C("fct_market_summary", "unique", ("date_stamp",)),
        *nn("fct_market_summary", "date_stamp", "total_market_cap", "top_gainer", "top_loser",
            "average_volume"),
        C("fct_market_summary", "non_negative", ("total_market_cap",)),
    ]


# Columns of each table's fingerprint.
FINGERPRINTS = {
    "stg_coin_markets": ["name_id", "symbol_name", "name_of_coin", "current_price", "market_cap", "high_24h", "low_24h",
                         "all_time_high_date", "last_updated", "ingested_at"],
    "stg_coin_price_history": ["coin_id", "coin_date", "open_price", "close_price", "high_price", "low_price",
                               "close_market_cap", "close_total_volume"],
    "int_coin_daily_metrics": METRIC_COLUMNS,
    "int_coin_categories": ["coin_id", "category", "name_of_coin", "prev_day_price", "daily_price_change_pcg",
                            "moving_avg_7d", "category_ingested_at", "date_stamp"],
    "dim_coins": ["coin_id", "coin_name", "symbol", "category", "first_seen_date"],
    "fct_daily_coin_performance": list(FACT_COLUMNS.values()),
    "fct_market_summary": ["date_stamp", "total_market_cap", "top_gainer", "top_loser", "average_volume"],
    "dim_coins_snapshot": ["coin_id", "coin_name", "symbol", "category", "first_seen_date", "valid_from", "valid_to", "is_current"],
}

FRESHNESS = [Q.Freshness(src, "_ingested_at", warn * 3600, error * 3600)
             for src, (warn, error) in FRESHNESS_HOURS.items()]


def run_daily_job(spark: SparkSession, cfg: JobConfig) -> JobResult:
    """Run the job; its staged intermediates live in one run scratch folder
    that is removed when the run succeeds (kept for inspection otherwise)."""
    configure(spark)
    folder = open_run_scratch(spark, "daily-job")
    ok = False
    try:
        res = _run(spark, cfg)
        ok = True
        return res
    finally:
        close_run_scratch(spark, folder, delete=ok)


def _run(spark: SparkSession, cfg: JobConfig) -> JobResult:
    res = JobResult()

    def put(name: str, df: DataFrame) -> DataFrame:
        path = table_path(cfg, name)
        publish(df, path)
        res.tables[name] = path
        return read_table(spark, path)

    # --- loads -----------------------------------------------------------------
    universe = stage(parse_universe(_universe_lines(spark, cfg)), "universe")
    series = SeriesTables(*(table_path(cfg, n) for n in (
        "coin_price_history", "stg_coin_price_history", "int_coin_daily_metrics", "asset_state", "merged_batches",
        "pending_bar_changes")))

    # Payloads are parsed once; what a load takes and what it rejects come off the same rows.
    def markets_load() -> tuple[LoadReport, DataFrame]:
        parsed = stage(parse_snapshots(read_snapshot_payloads(spark, cfg.landing), cfg.batch_ts), "parsed-markets")
        return load(accepted_snapshots(parsed), table_path(cfg, "coin_markets"), ["id"]), rejects(parsed)

    def charts_load() -> tuple[LoadReport, DataFrame]:
        payloads = read_keyed_payloads(spark, f"{cfg.landing}/charts").withColumn("_file_id", file_stem("source_file"))
        parsed = stage(parse_charts(payloads, cfg.batch_ts, cfg.chart_days, id_col="_file_id"), "parsed-charts")
        rows = restrict_to_universe(accepted_charts(parsed, "landed"), universe)
        path, log = series.raw, series.log(spark)
        n = rows.count()
        report = LoadReport(path, n, log.live().table_rows if log.exists() else 0, n == 0, None)
        if n:
            # Of charts of one (asset, window) the one landed last counts.
            live = log.append(latest_per_key(rows, list(log.keys), ["landed"]).drop("landed"), cfg.batch_ts)
            report.table_rows, report.version_path = live.table_rows, f"{path}/live"
        return report, rejects(parsed)

    def categories_load() -> tuple[LoadReport, DataFrame | None]:
        rows = restrict_to_universe(category_rows(read_keyed_payloads(spark, f"{cfg.landing}/categories"), cfg.batch_ts),
                                    universe, any_case=True)
        # Bucketed by asset, so that either way of replacing touches one bucket an asset.
        return load(rows, table_path(cfg, "coins_categories"), ["coin_id", "category"], bucket_by=["coin_id"],
                    replace_by=["coin_id"] if cfg.replace_categories_per_asset else None), None

    # The three loads are independent: submit them as concurrent Spark jobs
    # (each thread carries this run's context, so its scratch stays in the run).
    loads = {"coin_markets": markets_load, "coin_price_history": charts_load, "coins_categories": categories_load}
    refused = []
    with ThreadPoolExecutor(max_workers=len(loads)) as pool:
        futures = {name: pool.submit(contextvars.copy_context().run, run) for name, run in loads.items()}
        for name, fut in futures.items():
            res.loads[name], bad = fut.result()  # re-raises a failed load
            res.tables[name] = table_path(cfg, name)
            if bad is not None:
                refused.append(bad.select(F.lit(cfg.batch_ts).alias("batch_ts"), F.lit(name).alias("table_name"), "*"))
    rejected = put("rejected_input", refused[0].unionByName(refused[1]))
    for r in rejected.groupBy("table_name").count().collect():
        res.loads[r["table_name"]].rejected_rows = r["count"]
    _append_load_audit(spark, cfg, res)
    empty = [name for name in ("coin_markets", "coin_price_history") if res.loads[name].skipped]
    if empty and not cfg.allow_empty:
        raise EmptyLoadError(f"no rows landed for {', '.join(empty)}")
    raw_markets = read_partitioned(spark, table_path(cfg, "coin_markets"))
    raw_series = series.log(spark).read() if series.log(spark).exists() else spark.createDataFrame([], RAW_SERIES)
    raw_categories = (read_partitioned(spark, table_path(cfg, "coins_categories"))
                      if partitioned_exists(spark, table_path(cfg, "coins_categories")) else spark.createDataFrame([], RAW_CATEGORIES))
    # SET-1: universe assets that this run brought no chart of.
    came = raw_series.where(F.col("_ingested_at") == F.lit(cfg.batch_ts).cast("timestamp_ntz"))
    put("missing_assets", missing_keys(universe.select("coin_id"), came, "coin_id")
        .withColumn("batch_ts", F.lit(cfg.batch_ts)))

    # --- models ----------------------------------------------------------------
    as_of_date = cfg.as_of[:10]
    markets = put("stg_coin_markets", standardise_snapshot(raw_markets, as_of_date, cfg.as_of))
    cats = put("stg_coin_categories", standardise_categories(raw_categories))
    # Bars and metrics grow with history: an increment opens the raw batches and the
    # months that it touches and no others.
    bars_path, met_path = series.bars, series.metrics
    run_increment(spark, series, markets, cfg.price_scale, cfg.full_refresh, cfg.protect_boundary)
    bars = read_partitioned(spark, bars_path)
    res.tables["stg_coin_price_history"] = bars_path
    res.tables["int_coin_daily_metrics"] = met_path
    metrics = read_partitioned(spark, met_path)
    fact_path = res.tables["fct_daily_coin_performance"] = table_path(cfg, "fct_daily_coin_performance")
    cat_path = res.tables["int_coin_categories"] = table_path(cfg, "int_coin_categories")
    live = live_months(spark, met_path)
    marts = _concurrently({
        "fct_daily_coin_performance": lambda: follow_months(
            live, fact_path, "trade_date", lambda months: M.daily_fact(live.read(spark, months)), spark),
        "int_coin_categories": lambda: _category_metrics(
            spark, live, cats, read_state(spark, series.state), cat_path, _writes(spark, table_path(cfg, "coins_categories"))),
        "dim_coins": lambda: put("dim_coins", M.asset_dimension(cats, markets, bars)),
        "fct_market_summary": lambda: put("fct_market_summary", M.market_summary(metrics)),
    })
    fact, cat_metrics, dim, summary = marts.values()

    # --- snapshot and checks (independent of each other) --------------------------
    tables = {"stg_coin_markets": markets, "stg_coin_price_history": bars,
              "int_coin_daily_metrics": metrics, "int_coin_categories": cat_metrics,
              "dim_coins": dim, "fct_daily_coin_performance": fact, "fct_market_summary": summary}
    history_path = res.tables["dim_coins_snapshot"] = table_path(cfg, "dim_coins_snapshot")
    merge_history(history_path, dim, ["coin_id", "category"], ["coin_name", "symbol", "first_seen_date"], cfg.batch_ts)
    # Months whose write is the one of the last run keep their counts.
    parted = {"stg_coin_price_history": (bars_path, "coin_date"), "int_coin_daily_metrics": (met_path, "date_stamp"),
              "fct_daily_coin_performance": (fact_path, "trade_date"), "int_coin_categories": (cat_path, "date_stamp")}
    seen = {name: LedgerTable.of_months(spark, live_months(spark, path), col) for name, (path, col) in parted.items()}
    seen |= {name: LedgerTable.whole(df, cfg.batch_ts) for name, df in tables.items() if name not in parted}
    ledger = QualityLedger(spark, table_path(cfg, "quality_ledger")).refresh(
        seen, model_checks(), {"stg_coin_price_history": read_state(spark, series.state)})
    prints = [fingerprint(df, name, FINGERPRINTS[name])
              for name, df in {**tables, "dim_coins_snapshot": read_history(spark, history_path)}.items()]
    last = {
        "table_fingerprints": reduce(DataFrame.unionByName, prints).withColumn("batch_ts", F.lit(cfg.batch_ts)),
        "quality_report": ledger,
        "source_freshness": Q.freshness(
            spark, {"coin_markets": raw_markets, "coin_price_history": raw_series,
                    "coins_categories": raw_categories}, FRESHNESS, cfg.as_of),
    }
    last = _concurrently({name: partial(put, name, df) for name, df in last.items()})
    report = last["quality_report"]
    if cfg.fail_on_error:
        Q.gate(report)
        Q.freshness_gate(last["source_freshness"])
    # Storage stays bounded: older versions of every versioned table go once
    # the run has passed (a failed run keeps everything for inspection).
    for path in res.tables.values():
        if table_exists(spark, path):
            vacuum(spark, path, keep=cfg.keep_versions)
    for path in (*res.tables.values(), series.state):
        if partitioned_exists(spark, path):
            vacuum_partitioned(spark, path, keep=cfg.keep_versions)
    for path in (series.pending, series.merged, f"{series.raw}/index", table_path(cfg, "quality_ledger"),
                 f"{fact_path}/followed", f"{cat_path}/followed"):
        if table_exists(spark, path):
            vacuum(spark, path, keep=cfg.keep_versions)
    return res


def _writes(spark: SparkSession, path: str) -> str:
    """Names the contents of a table in parts."""
    return json.dumps(live_months(spark, path).writes, sort_keys=True) if partitioned_exists(spark, path) else ""


def _category_metrics(spark: SparkSession, live: Months, cats: DataFrame, state: DataFrame, path: str, cats_writes: str) -> DataFrame:
    """JOB-3: the category metrics follow the metrics month by month; categories that
    came again carry a new ingest time, so a new category load rewrites all months.
    Assets without history stand in the part without a date."""
    def rows(months: Sequence[str] | None) -> DataFrame:
        if months is None:
            return M.category_metrics(cats, live.read(spark))
        some = M.category_metrics(cats, live.read(spark, months), how="inner")
        without = cats.join(state.select("coin_id"), "coin_id", "left_anti")
        return some.unionByName(M.category_metrics(without, live.read(spark, [])))

    return follow_months(live, path, "date_stamp", rows, spark, other=cats_writes, always=[NO_DATE])


def _concurrently(tasks: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Publish independent tables as concurrent Spark jobs; returns them read back."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(contextvars.copy_context().run, task) for name, task in tasks.items()}
        return {name: fut.result() for name, fut in futures.items()}


AUDIT_SCHEMA = ("batch_ts timestamp_ntz, table_name string, batch_rows long, table_rows long, "
                "skipped boolean, version_path string, collided_rows long, refused_rows long, rejected_rows long")


def _append_load_audit(spark: SparkSession, cfg: JobConfig, res: JobResult) -> None:
    """SNK-10: one audit row per load of this run, appended to ``load_audit``."""
    from datetime import datetime

    ts = datetime.fromisoformat(cfg.batch_ts)
    rows = [(ts, name, r.batch_rows, r.table_rows, r.skipped, r.version_path, r.collided_rows, r.refused_rows, r.rejected_rows)
            for name, r in res.loads.items()]
    new = spark.createDataFrame(rows, AUDIT_SCHEMA)  # three rows: the run's loads
    path = table_path(cfg, "load_audit")
    publish(read_table(spark, path).unionByName(new, allowMissingColumns=True) if table_exists(spark, path) else new, path)
    res.tables["load_audit"] = path


def _universe_lines(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """The landed id lists, else the default universe as one list."""
    path = f"{cfg.landing}/universe"
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return spark.read.text(path)
    return spark.createDataFrame([(",".join(DEFAULT_UNIVERSE),)], "value string")
