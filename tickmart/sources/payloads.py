"""Landed API payload scans (SRC-1, SRC-2, SRC-3) and the raw-row shaping.

Snapshot lists are landed one API response per file and read whole
(``wholetext``), or, where very many files would cost more than their bytes, one
response per line.  Payload order survives as (file path, line, position) for
keep-first: a payload is bounded by the API page size.  Keyed payloads (charts, categories) may also be landed as JSON Lines.

Every payload is parsed once, into a VARIANT, and each field is taken from it with
``try_variant_get``.  What does not fit its column is not lost and never becomes a
default: the field is NULL, its name is in ``rejected_fields``, and a reject row
(id, field, raw text, reason, source file) comes off the same parse (``parse_*`` ->
``accepted_*`` and ``rejects``).  The functions take any DataFrame with a column of
JSON text, so payloads built in Spark (as the driver queries do) go through the same
parse.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions import non_blank
from tickmart.operators.dedupe import keep_first
from tickmart.sinks.tables import _fs
from tickmart.schemas import CATEGORY_PAYLOAD, RAW_NUM, RAW_SERIES, RAW_SNAPSHOT, REJECTS, SERIES

NOT_A_NUMBER, OUT_OF_RANGE, NOT_A_DATE = "not a number", "out of range", "not a date"
_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
_NUM, _SERIES, _TEXT_SERIES = RAW_NUM.simpleString(), SERIES.simpleString(), "array<array<string>>"
SERIES_NAMES = ("prices", "market_caps", "total_volumes")


def read_payloads(spark: SparkSession, path: str, whole_files: bool = True, glob: str | None = None) -> DataFrame:
    """Landed payloads: ``payload`` (text), ``source_file`` (its path) and ``landed``, which
    orders payloads as they stand in the files (by path).

    ``whole_files``: one payload per file (API responses as fetched; keeps
    payload order for keep-first).  Otherwise JSON Lines, one payload per
    line, for keyed payloads where order within a file does not matter.
    ``glob`` limits the file names read.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return (reader.text(path, wholetext=whole_files)
            .select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file"),
                    F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("line")).alias("landed")))


def read_snapshot_payloads(spark: SparkSession, landing: str) -> DataFrame:
    """Snapshot lists, landed either way: whole files in ``markets/``, lines of the files in
    ``market_lines/`` (at least one of the two folders is there)."""
    fs, lines = _fs(spark, f"{landing}/market_lines")
    if not fs.exists(lines):
        return read_payloads(spark, f"{landing}/markets")
    found = read_payloads(spark, f"{landing}/market_lines", whole_files=False)
    fs, whole = _fs(spark, f"{landing}/markets")
    return read_payloads(spark, f"{landing}/markets").unionByName(found) if fs.exists(whole) else found


def read_keyed_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Charts or categories, landed either way: a ``*.json`` file is one response as
    fetched, pretty-printed or not (or lines, if its first line is a JSON value by
    itself); any other file is JSON Lines, which Spark splits."""
    lines = read_payloads(spark, path, whole_files=False).where(~F.lower("source_file").endswith(".json"))
    whole = read_payloads(spark, path, glob="*.json")
    written = F.filter(F.split("payload", "\n"), lambda x: F.trim(x) != "")
    parts = F.when(F.try_parse_json(F.get(written, F.lit(0))).isNotNull(), written).otherwise(F.array("payload"))
    each = whole.select(F.posexplode(parts).alias("line", "payload"), "source_file", "landed")
    return lines.unionByName(each.select("payload", "source_file",
                                         F.col("landed").withField("line", F.col("line").cast("long")).alias("landed")))


def file_stem(source_col: str) -> Column:
    """Name of a ``*.json`` file without its ending; NULL for others.  The ending is looked
    at first: on a path that lacks it the expression tries every part of the path."""
    path = F.col(source_col)
    return F.when(path.endswith(".json"), F.regexp_extract(path, r"([^/]+)\.json$", 1))


def _stamp(batch_ts: str | Column) -> Column:
    ts = F.lit(batch_ts) if isinstance(batch_ts, str) else batch_ts
    return ts.cast("timestamp_ntz")


def _reject(field: str | Column, raw: Column, reason: str | Column) -> Column:
    lit = [F.lit(x) if isinstance(x, str) else x for x in (field, reason)]
    return F.struct(lit[0].alias("field"), raw.alias("raw"), lit[1].alias("reason"))


def _number_reason(raw: Column) -> Column:
    return F.when(raw.rlike(_NUMBER), OUT_OF_RANGE).otherwise(NOT_A_NUMBER)


def rejects(parsed: DataFrame, *keep: str) -> DataFrame:
    """The reject rows of a parse: id, field, raw, reason, source_file (and ``keep``)."""
    return parsed.select(F.col("id" if "id" in parsed.columns else "coin_id").alias("id"),
                         F.explode("rejects").alias("r"), "source_file", *keep).select(
        "id", "r.field", "r.raw", "r.reason", "source_file", *keep)


# --- snapshots ------------------------------------------------------------------------

_PATHS = {"roi_times": "$.roi.times", "roi_currency": "$.roi.currency", "roi_percentage": "$.roi.percentage"}


def parse_snapshots(payloads: DataFrame, batch_ts: str | Column,
                    payload_col: str = "payload", source_col: str = "source_file") -> DataFrame:
    """SRC-1 + PRJ-1 + PRJ-2: payload lists -> raw snapshot columns, one row a coin of
    any payload, with ``rejected_fields``, ``rejects`` and where the coin stood.

    A payload that is no list, and a coin without an id, give a row without id that
    holds nothing but its reject.
    """
    v = F.try_parse_json(payload_col)
    landed = ["landed"] if "landed" in payloads.columns else []
    # A list's coins, or one NULL: the payload itself is then rejected.
    listed = payloads.select(F.col(source_col).alias("source_file"), *landed, F.col(payload_col).alias("_payload"),
                             F.try_variant_get(v, "$", "array<variant>").alias("_coins"))
    coins = listed.select("source_file", *landed, F.when(F.col("_coins").isNull(), F.col("_payload")).alias("_payload"),
                          F.posexplode_outer("_coins").alias("position", "c"))

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("c", path, kind)

    taken: dict[str, Column] = {}
    raws: dict[str, tuple[Column, Column]] = {}
    for f in RAW_SNAPSHOT.fields:
        path, kind = _PATHS.get(f.name, f"$.{f.name}"), f.dataType.simpleString()
        if f.name in ("_ingested_at", "rejected_fields"):
            continue
        raw = get(path, "string")
        if f.dataType == RAW_NUM:
            taken[f.name], raws[f.name] = get(path, _NUM), (raw, _number_reason(raw))
        elif kind == "string":
            taken[f.name] = raw
        else:
            taken[f.name] = F.try_to_timestamp(raw).cast(kind)
            raws[f.name] = (raw, F.lit(NOT_A_DATE))
    coins = coins.select("source_file", *landed, "position", "_payload", "c", *[c.alias(n) for n, c in taken.items()])
    unfit = [F.when(F.col(n).isNull() & raw.isNotNull(), _reject(n, raw, why)) for n, (raw, why) in raws.items()]
    whole = F.when(F.col("position").isNull() & F.col("_payload").isNotNull(), _reject("payload", F.col("_payload"), "not a list"))
    nameless = F.when(F.col("c").isNotNull() & ~F.coalesce(non_blank(F.col("id")), F.lit(False)),
                      _reject("id", F.to_json("c"), "no id"))
    known = F.coalesce(non_blank(F.col("id")), F.lit(False))
    found = F.when(known, F.filter(F.array(*unfit), lambda r: r.isNotNull())).otherwise(
        F.filter(F.array(whole, nameless), lambda r: r.isNotNull()))
    parsed = coins.withColumn("rejects", found).withColumn("id", F.when(known, F.col("id")))
    names = F.when(F.size("rejects") > 0, F.transform("rejects", lambda r: r["field"]))
    return (parsed.withColumn("rejected_fields", names).withColumn("_ingested_at", _stamp(batch_ts))
            .select(*RAW_SNAPSHOT.names, "rejects", "source_file", *landed, "position"))


def accepted_snapshots(parsed: DataFrame) -> DataFrame:
    """FLT-1 + TOP-4: within the batch the first occurrence of an id (file path, then
    line, then list position) wins."""
    landed = ["landed"] if "landed" in parsed.columns else []
    first = keep_first(parsed.where(F.col("id").isNotNull()), ["id"], ["source_file", *landed, "position"])
    return first.select(*RAW_SNAPSHOT.names)


def snapshot_rows(payloads: DataFrame, batch_ts: str | Column,
                  payload_col: str = "payload", source_col: str = "source_file") -> DataFrame:
    """The raw snapshot rows of payloads (see :func:`parse_snapshots`)."""
    return accepted_snapshots(parse_snapshots(payloads, batch_ts, payload_col, source_col))


# --- charts ---------------------------------------------------------------------------

def parse_charts(payloads: DataFrame, batch_ts: str | Column, chart_days: int | Column,
                 payload_col: str = "payload", id_col: str | None = None) -> DataFrame:
    """SRC-2: chart payload -> raw series row; a missing/null series becomes ``[]``.

    A payload without any series (error object, HTML, half a file) or without an id
    gives a row without id that holds nothing but its reject, so it never overwrites a
    stored chart.  A point with a number that is none or does not fit is set aside: its
    place is taken out of all three series (which are joined by place), and each such
    number is a reject row.  JSON nulls stay NULL.

    The asset id is the payload's ``id`` field, else ``id_col`` (e.g. the file
    name stem); the window is the payload's ``chart_days``, else ``chart_days``.
    """
    v = F.try_parse_json(payload_col)
    coin_id = F.try_variant_get("_v", "$.id", "string")
    if id_col is not None:
        coin_id = F.coalesce(coin_id, F.col(id_col))
    days = F.coalesce(F.try_variant_get("_v", "$.chart_days", "int"),
                      F.lit(chart_days) if isinstance(chart_days, int) else chart_days)
    source = F.col("source_file") if "source_file" in payloads.columns else F.lit(None).cast("string")
    landed = ["landed"] if "landed" in payloads.columns else []
    read = payloads.withColumn("_v", v).select(
        F.col(payload_col).alias("_payload"), source.alias("source_file"), *landed,
        F.when(non_blank(coin_id), coin_id).alias("coin_id"), days.cast("int").alias("chart_days"), F.col("_v").isNotNull().alias("_json"),
        "_v", *[F.try_variant_get("_v", f"$.{s}", _SERIES).alias(s) for s in SERIES_NAMES])

    def text(s: str) -> Column:
        """The series as text, if a number of it may not have fitted (a NULL is there)."""
        gaps = F.exists(s, lambda pair: pair.isNull() | F.exists(pair, lambda x: x.isNull()))
        return F.when(F.col(s).isNull() | gaps, F.try_variant_get("_v", f"$.{s}", _TEXT_SERIES))

    read = read.select("*", *[text(s).alias(f"_{s}") for s in SERIES_NAMES])

    def unfit(s: str) -> Column:
        """(field, raw, reason, place) of the numbers of a series that did not fit."""
        def value(raw: Column, place: Column, k: Column) -> Column:
            field = F.concat(F.lit(f"{s}["), place.cast("string"), F.lit("]["), k.cast("string"), F.lit("]"))
            got = F.get(F.get(F.col(s), place), k)
            return F.when(raw.isNotNull() & got.isNull(),
                          F.struct(field.alias("field"), raw.alias("raw"), _number_reason(raw).alias("reason"), place.alias("place")))

        found = F.transform(f"_{s}", lambda pair, place: F.transform(pair, lambda raw, k: value(raw, place, k)))
        none = F.array().cast("array<struct<field:string,raw:string,reason:string,place:int>>")
        return F.coalesce(F.filter(F.flatten(F.filter(found, lambda x: x.isNotNull())), lambda x: x.isNotNull()), none)

    read = read.withColumn("_bad", F.concat(*[unfit(s) for s in SERIES_NAMES]))
    empty = F.array().cast(SERIES)

    def series(s: str) -> Column:
        kept = F.filter(s, lambda _, place: ~F.exists("_bad", lambda b: b["place"] == place))
        return F.coalesce(F.when(F.size("_bad") == 0, F.col(s)).otherwise(kept), empty).alias(s)

    has = reduce(lambda a, b: a | b, [F.col(s).isNotNull() for s in SERIES_NAMES])
    usable = has & F.col("coin_id").isNotNull()
    whole = F.when(~F.col("_json"), "not JSON").when(~has, "no series").otherwise("no id")
    found = F.when(usable, F.transform("_bad", lambda b: _reject(b["field"], b["raw"], b["reason"]))).otherwise(
        F.array(_reject("payload", F.col("_payload"), whole)))
    return read.select(F.when(usable, F.col("coin_id")).alias("coin_id"), "chart_days", *[series(s) for s in SERIES_NAMES],
                       _stamp(batch_ts).alias("_ingested_at"), found.alias("rejects"), "source_file", *landed)


def accepted_charts(parsed: DataFrame, *keep: str) -> DataFrame:
    return parsed.where(F.col("coin_id").isNotNull()).select(*RAW_SERIES.names, *keep)


def chart_rows(payloads: DataFrame, batch_ts: str | Column, chart_days: int | Column,
               payload_col: str = "payload", id_col: str | None = None) -> DataFrame:
    """The raw series rows of payloads (see :func:`parse_charts`)."""
    return accepted_charts(parse_charts(payloads, batch_ts, chart_days, payload_col, id_col))


def category_rows(payloads: DataFrame, batch_ts: str | Column,
                  payload_col: str = "payload") -> DataFrame:
    """SRC-3: ``{id, categories[]}`` -> one row per (asset, category).

    A NULL list is empty; NULL category entries cannot be stored (NOT NULL) and
    are skipped; a repeated category of one asset is kept once.
    """
    c = F.from_json(F.col(payload_col), CATEGORY_PAYLOAD)
    return (payloads
            .select(c["id"].alias("coin_id"),
                    F.explode(F.coalesce(c["categories"], F.array().cast("array<string>")))
                    .alias("category"))
            .where(non_blank(F.col("coin_id")) & F.col("category").isNotNull())
            .dropDuplicates(["coin_id", "category"])
            .withColumn("_ingested_at", _stamp(batch_ts)))
