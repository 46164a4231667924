"""Run the daily job: ``spark-submit -m tickmart`` / ``python -m tickmart``.

    python -m tickmart --landing <dir> --warehouse <dir> \
        --batch-ts "2024-01-31 06:00:00" [--as-of ...] [--full-refresh]

The session comes from ``spark-submit`` (or a local one when run directly);
its ``spark.checkpoint.dir`` is used for scratch tables.
"""

from __future__ import annotations

import argparse
import json
import sys

from tickmart.fixed import DEFAULT_CHART_DAYS, PRICE_SCALE
from tickmart.operators.quality import QualityGateError
from tickmart.plans.daily_job import JobConfig, run_daily_job
from tickmart.session import get_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tickmart", description="Run the daily job.")
    p.add_argument("--landing", required=True, help="folder with universe/ markets/ charts/ categories/")
    p.add_argument("--warehouse", required=True, help="root folder of the layered tables")
    p.add_argument("--batch-ts", required=True, help="lineage stamp of this run's loads (UTC)")
    p.add_argument("--as-of", help="the run's 'now' (UTC); defaults to --batch-ts")
    p.add_argument("--chart-days", type=int, default=DEFAULT_CHART_DAYS)
    p.add_argument("--price-scale", type=int, default=PRICE_SCALE)
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--protect-boundary", action="store_true")
    p.add_argument("--replace-categories-per-asset", action="store_true")
    p.add_argument("--keep-versions", type=int, default=3,
                   help="committed versions kept per versioned table after a passing run")
    p.add_argument("--no-gate", action="store_true", help="report failures without failing")
    a = p.parse_args(argv)
    cfg = JobConfig(landing=a.landing, warehouse=a.warehouse, batch_ts=a.batch_ts,
                    as_of=a.as_of or a.batch_ts, chart_days=a.chart_days,
                    price_scale=a.price_scale, full_refresh=a.full_refresh,
                    fail_on_error=not a.no_gate, protect_boundary=a.protect_boundary,
                    replace_categories_per_asset=a.replace_categories_per_asset,
                    keep_versions=a.keep_versions)
    spark = get_session()
    try:
        result = run_daily_job(spark, cfg)
    except QualityGateError as e:
        print(str(e), file=sys.stderr)
        return 2
    print(json.dumps({"loads": {k: vars(v) for k, v in result.loads.items()},
                      "tables": result.tables}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
