"""Language ID (operator 9): Bayesian evidence fusion.

Evidence of a document: the likelihood of its byte trigrams under each language
(and under "no language", all trigrams alike), the language its markup declares,
its address suffix, and its host.  How far a declaration or a suffix speaks for a
language is estimated from all documents by grouped aggregation of their text
posteriors; a host's prior is the mean of its other documents, shrunk towards
that of its suffix, and that towards the global one.

Only likely languages of a row are carried: those whose tempered log likelihood lies
within ``MARGIN`` of its best.  The other evidence moves a language by log(FLOOR) three
times (62) at most, so what is left out has less than e^-48 of the best one's probability,
under the precision of a double.  Languages are scored ``HELD * TABLES`` a scan of the
documents (134 MB of tables), so neither the driver nor a task holds more, however many
codes are declared; of the codes themselves the driver holds the list.

The trigram tables are fitted on about ``SAMPLE`` ids of each declared language, the
ones of smallest hash (all of them, if it has fewer): every declared language with a
trigram has a table, whatever its share.  Everything else covers all documents.

Defined results: a text without letters (null and empty ones too) is rejected, one
of too few for a trigram is judged by the other evidence; null declarations, hosts and addresses are values of
their own; without declared languages all documents are rejected;
repeated rows are evidence each; an empty table gives no rows.  Only the named
columns are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.evidence import shrunk
from tickmart.llm.textscan import column_bytes, fold_table, row_chunks
from tickmart.operators.joins import small_side
from tickmart.sinks.tables import stage

SAMPLE = 2_000          # ids of each declared language that its trigram table is fitted on
HELD = 64               # languages of a table (16 MB); a task counts as many at a time
TABLES = 8              # tables broadcast for one scan of the documents
BINS = 1 << 16
TEMPER = 1 / 3          # neighbouring trigrams share two of three bytes
STRENGTH = 10.0         # rows of the level above that a group is weighed against
FLOOR = 1e-9            # least probability of a declaration, a suffix, a host's prior
MARGIN = 110.0          # see the module's text
UNKNOWN = "und"


def _letters() -> np.ndarray:
    t = fold_table()
    t[:128][~np.isin(np.arange(128), [*range(65, 91), *range(97, 123)])] = 32
    return t


LETTERS = _letters()


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, counts) for each byte place: the trigram that starts there, if it
    lies within one document and holds a letter."""
    b = LETTERS[data].astype(np.uint32)
    n = len(b)
    bins, valid = np.zeros(n, np.int64), np.zeros(n, bool)
    if n >= 3:
        a, c, d = b[:-2], b[1:-1], b[2:]
        bins[:-2] = ((a * np.uint32(0x9E3779B1)) ^ (c * np.uint32(0x85EBCA77)) ^ (d * np.uint32(0xC2B2AE3D))) >> np.uint32(16)
        valid[:-2] = (a != 32) | (c != 32) | (d != 32)
    ends = offsets[1:]
    for back in (1, 2):
        at = ends - back
        valid[at[at >= 0]] = False
    return bins, valid


class Model:
    """Trigram counts by language, kept as a stored table; log probabilities are made for
    a few languages at a time.  The last language is UNKNOWN."""

    def __init__(self, counts: DataFrame):
        self.counts = counts
        self.codes = sorted(r[0] for r in counts.select("declared").distinct().collect())
        self.languages = [*self.codes, UNKNOWN]

    def rows(self, lo: int, hi: int) -> np.ndarray:
        """Log probabilities of the trigram bins under languages lo to hi."""
        codes = self.languages[lo:hi]
        known = codes[:-1] if hi > len(self.codes) else codes
        table = np.full((len(codes), BINS), -np.log(BINS))
        if known:
            order = F.create_map(*(F.lit(x) for j, c in enumerate(known) for x in (c, j)))
            # At most BINS counts a language.
            found = (self.counts.where(F.col("declared").isin(known))
                     .select(order[F.col("declared")].alias("j"), "bin", "n").toPandas())
            t = np.zeros((len(known), BINS))
            t[found["j"].to_numpy(int), found["bin"].to_numpy(int)] = found["n"].to_numpy(float)
            table[:len(known)] = np.log((t + 0.5) / (t.sum(axis=1, keepdims=True) + 0.5 * BINS))
        return table.astype(np.float32)

    @property
    def table(self) -> np.ndarray:
        return self.rows(0, len(self.languages))


def log_likelihoods(tables, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihoods, letters) of each document under the rows of the tables."""
    bins, valid = trigrams(data, offsets)
    count = np.concatenate(([0], np.cumsum(LETTERS[data] != 32)))
    columns = []
    for table in tables:
        for row in table:
            sums = np.concatenate(([0.0], np.cumsum(np.where(valid, row[bins], 0), dtype=np.float64)))
            columns.append(sums[offsets[1:]] - sums[offsets[:-1]])
    return np.stack(columns, axis=1), count[offsets[1:]] - count[offsets[:-1]]


def fit(docs: DataFrame, declared: str = "lang", sample: int = SAMPLE) -> Model:
    """Trigram tables of the declared languages, each of a bounded sample of its ids."""
    # Rows without id are told apart by their text.  A row has a trigram if it has a letter and three bytes.
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    named = (docs.select("doc_id", F.col(f"`{declared}`").cast("string").alias("declared"), "text")
             .where("declared IS NOT NULL AND octet_length(text) >= 3")
             .where(F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]"))
             .select("declared", key.alias("key"), "text"))
    # The ids whose hash lies in the lowest sample / ids of its range: no task holds a language.
    ids = named.groupBy("declared").agg(F.approx_count_distinct("key").alias("ids"))

    def count(batches):
        totals: dict[str, np.ndarray] = {}

        def counted():
            for code, t in totals.items():
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(at), pa.string()), pa.array(at), pa.array(t[at])],
                                                 names=["declared", "bin", "n"])
            totals.clear()

        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, code in enumerate(batch.column(0).to_pylist()):
                own = data[offsets[i]:offsets[i + 1]]
                bins, valid = trigrams(own, np.array([0, len(own)]))
                if code not in totals:
                    if len(totals) == HELD:
                        yield from counted()
                    totals[code] = np.zeros(BINS, np.int64)
                totals[code] += np.bincount(bins[valid], minlength=BINS)
        yield from counted()

    # A row a declared language, measured before it is broadcast.
    found = (named.join(small_side(stage(ids, "languages")), "declared")
             .where((F.col("key") / 2.0 ** 64 + 0.5) * F.col("ids") <= sample)
             .select("declared", "text").mapInArrow(count, "declared string, bin long, n long")
             .groupBy("declared", "bin").agg(F.sum("n").alias("n")))
    return Model(stage(found, "trigrams"))


def suffix_of(url: Column) -> tuple[Column, Column]:
    """(host, address suffix) of a url: its last host label and a leading two-letter
    path part, such as ``org/en``."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*:?//([^/?#:]*)", 1))
    code = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*:?//[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return host, F.concat_ws("/", F.substring_index(host, ".", -1), code)


def declared_of(page: Column) -> Column:
    """Language code that an html element declares."""
    code = F.lower(F.regexp_extract(page, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(code != "", code)


def _likely(docs: DataFrame, tables: list, first: int, columns: dict[str, Column]) -> DataFrame:
    """``columns``, n_letters and the likely languages (number, log likelihood) of each
    row, of those in ``tables`` (broadcasts), which are numbered from ``first``."""
    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(batch.num_columns - 1))
            sizes, js, ss, letters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
            for lo, hi in row_chunks(offsets):
                s, c = log_likelihoods((t.value for t in tables), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                s *= TEMPER
                row, j = np.nonzero(s >= s.max(axis=1, keepdims=True) - MARGIN)
                sizes.append(np.bincount(row, minlength=hi - lo))
                js.append(j + first)
                ss.append(s[row, j])
                letters.append(c)
            ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
            likely = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(np.concatenate(js).astype(np.int32)), pa.array(np.concatenate(ss))], names=["j", "s"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(letters)), likely],
                                             names=[*batch.schema.names[:-1], "n_letters", "likely"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = ", ".join([f"doc_id {kind}", *(f"{c} {'long' if c == 'text_key' else 'string'}" for c in columns),
                     "n_letters long", "likely array<struct<j:int,s:double>>"])
    return docs.select("doc_id", *(v.alias(k) for k, v in columns.items()), "text").mapInArrow(run, ddl)


def _scored(docs: DataFrame, model: Model, columns: dict[str, Column], held: int, tables: int) -> DataFrame:
    """Rows with their likely languages and the share ``t`` of each by the text alone."""
    def scan(lo: int, some: dict[str, Column]) -> DataFrame:
        last = min(len(model.languages), lo + held * tables)
        shared = [docs.sparkSession.sparkContext.broadcast(model.rows(at, min(at + held, last))) for at in range(lo, last, held)]
        return _likely(docs, shared, lo, some)

    rows = scan(0, columns)
    for lo in range(held * tables, len(model.languages), held * tables):
        # The likelihoods are of the text: rows of one id and text share them.
        more = scan(lo, {"text_key": columns["text_key"]}).select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("likely").alias("_likely")).dropDuplicates(["_id", "_key"])
        rows = stage(rows, "likelihoods").join(more, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        rows = rows.withColumn("likely", F.concat("likely", "_likely")).drop("_id", "_key", "_likely")
    best = F.array_max(F.transform("likely", lambda x: x["s"]))
    rows = rows.withColumn("_best", best).withColumn("likely", F.filter("likely", lambda x: x["s"] >= F.col("_best") - MARGIN))
    rows = rows.withColumn("_sum", F.aggregate("likely", F.lit(0.0), lambda acc, x: acc + F.exp(x["s"] - F.col("_best"))))
    share = F.transform("likely", lambda x: F.struct(x["j"].alias("j"), x["s"].alias("s"), (F.exp(x["s"] - F.col("_best")) / F.col("_sum")).alias("t")))
    return rows.withColumn("likely", share).drop("_best", "_sum")


def language_id(docs: DataFrame, declared: str = "lang", host: str | None = "source", url: str | None = None,
                sample: int = SAMPLE, least: float = 0.5, held: int = HELD, tables: int = TABLES) -> DataFrame:
    """doc_id, text_key (hash of the text), language, confidence, kept of every row;
    ``url`` names an address column that gives host and suffix.  The languages are scored
    in ``tables`` tables of ``held`` languages a scan of the documents."""
    model = fit(docs, declared, sample)
    n = len(model.languages)
    address_host, suffix = suffix_of(F.col(f"`{url}`")) if url else (None, F.lit(""))
    site = address_host if url else F.col(f"`{host}`").cast("string") if host else F.lit("")
    rows = stage(_scored(docs, model, {
        "text_key": F.xxhash64(F.coalesce("text", F.lit(""))),
        "declared": F.coalesce(F.col(f"`{declared}`").cast("string"), F.lit("")),
        "suffix": F.coalesce(suffix, F.lit("")), "site": F.coalesce(site, F.lit(""))}, held, tables), "likelihoods")

    # One pass to (declared, suffix, site, language) sums; every level is summed from these.
    # The first likely language of a row counts it.
    cells = stage(rows.select("declared", "suffix", "site", F.posexplode("likely").alias("at", "x"))
                  .groupBy("declared", "suffix", "site", F.col("x.j").alias("j"))
                  .agg(F.count_if(F.col("at") == 0).alias("n"), F.sum("x.t").alias("t")), "language-cells")
    total = float(cells.agg(F.sum("n")).first()[0] or 0) or 1.0
    mass = stage(cells.groupBy("j").agg(F.sum("t").alias("m")), "language-mass")    # a row a language

    def level(keys: list[str], prefix: str, **more: str) -> DataFrame:
        """Rows of each group, and a map from its languages to their sums."""
        sums = cells.groupBy(*keys, "j").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
        if more:
            sums = sums.join(mass, "j")
        return sums.groupBy(*keys).agg(F.sum("n").alias(f"{prefix}n"), F.map_from_entries(F.collect_list(
            F.struct("j", "t"))).alias(f"{prefix}t"), *(F.map_from_entries(F.collect_list(F.struct("j", c))).alias(name) for name, c in more.items()))

    # A language that is likely for a row is in the maps of the row's groups.
    joined = (rows.join(level(["declared"], "d_", mass="m"), "declared").join(level(["suffix"], "x_"), "suffix")
              .join(level(["suffix", "site"], "h_"), ["suffix", "site"]))

    def score(x: Column) -> Column:
        j, own = x["j"], x["t"]
        d, ends, site_sum, all_ = (F.col(c)[j] for c in ("d_t", "x_t", "h_t", "mass"))
        # P(value | language), shrunk to the value's share of all rows.
        said = (d - own + STRENGTH * F.col("d_n") / total) / (all_ - own + STRENGTH)
        end = (ends - own + STRENGTH * F.col("x_n") / total) / (all_ - own + STRENGTH)
        region = shrunk(ends, F.col("x_n"), own, (all_ + 1) / (total + n), STRENGTH)
        prior = shrunk(site_sum, F.col("h_n"), own, region, STRENGTH)
        floor = F.lit(FLOOR)
        return x["s"] + F.log(F.greatest(said, floor)) + F.log(F.greatest(end, floor)) + F.log(F.greatest(prior, floor))

    scored = joined.select("doc_id", "text_key", "n_letters", F.transform("likely", lambda x: x["j"]).alias("js"),
                           F.transform("likely", score).alias("score"))
    top = F.array_max("score")
    best = F.element_at("js", F.array_position("score", top).cast("int"))
    sure = 1 / F.aggregate("score", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    names = docs.sparkSession.createDataFrame(list(enumerate(model.languages)), "j int, name string")
    known = (F.col("n_letters") > 0) & (F.col("language") != UNKNOWN) & (F.col("confidence") >= least)
    return (scored.withColumn("top", top).withColumn("j", best).withColumn("confidence", sure).join(names, "j")
            .withColumn("language", F.when(F.col("n_letters") > 0, F.col("name")).otherwise(UNKNOWN))
            .select("doc_id", "text_key", "language", "confidence", known.alias("kept")))


def keep_known(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose language is rejected, all columns kept."""
    bad = stage(language_id(docs, **options).where("NOT kept").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "rejected")
    keyed = docs.withColumn("_text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    return (keyed.join(bad, (keyed["_text_key"] == bad["_key"]) & keyed["doc_id"].eqNullSafe(bad["_id"]), "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
