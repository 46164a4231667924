"""PRJ-3, PRJ-4, TOP-2: staged snapshot and bridge."""

from conftest import D, d, ts

from tickmart.operators.standardise import SNAPSHOT_RULES, standardise_categories, standardise_snapshot
from tickmart.schemas import RAW_SNAPSHOT


def raw(spark, values):
    full = [{f.name: None for f in RAW_SNAPSHOT.fields} | v for v in values]
    return spark.createDataFrame([tuple(r[f.name] for f in RAW_SNAPSHOT.fields) for r in full],
                                 RAW_SNAPSHOT)


def test_defaults_trim_round_and_dates(spark):
    df = raw(spark, [
        {"id": " btc ", "symbol": None, "name": "Bitcoin\t", "current_price": D("0.005"),
         "market_cap_rank": D(1), "total_volume": D("1.23456"), "low_24h": D("-0.005"),
         "ath_date": d("2021-11-10"), "atl_date": d("2015-10-20"),
         "_ingested_at": ts("2024-01-31 06:00:00")},
        {"id": "eth", "_ingested_at": ts("2024-01-30 06:00:00")},
        {"id": "eth", "symbol": "newer", "_ingested_at": ts("2024-01-31 06:00:00")},
    ])
    out = {r.name_id: r for r in standardise_snapshot(df, "2024-02-01", "2024-02-01 06:00:00").collect()}
    assert set(out) == {"btc", "eth"}
    b = out["btc"]
    assert (b.symbol_name, b.name_of_coin, b.coin_image) == ("Unknown", "Bitcoin\t", "Unknown")
    assert b.current_price == D("0.01") and b.low_24h == D("-0.01") and b.market_cap == D(0)
    assert b.total_volume == D("1.23456") and b.market_cap_rank == D(1)   # not rounded
    assert b.all_time_high_date == d("2021-11-10") and b.all_time_low_date == d("2015-10-20")
    assert b.last_updated == ts("2024-02-01 06:00:00")                     # as_of default
    e = out["eth"]
    assert e.symbol_name == "newer"                                        # newest ingest kept
    assert e.all_time_high_date == d("2024-02-01") and e.all_time_low_date == d("2024-02-01")
    assert len(SNAPSHOT_RULES) == 27 and len(b) == 27


def test_bridge_cleanup(spark):
    df = spark.createDataFrame([(" a ", " DeFi ", ts("2024-01-01 00:00:00"))],
                               "coin_id string, category string, _ingested_at timestamp")
    r = standardise_categories(df).collect()[0]
    assert (r.coin_id, r.category) == ("a", "DeFi")
    assert dict(standardise_categories(df).dtypes)["_ingested_at"] == "timestamp_ntz"
