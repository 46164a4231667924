"""Quality classifier (operator 1): hierarchical empirical Bayes.

A document classifier (logistic regression on counts of the whole text: word
length, case, symbols, repetition, ...) gives each document a probability.
Grouped aggregation gives every host, and every path within a host, a posterior
mean: the mean of the other documents there, shrunk towards the level above
(path to host, host to the global mean) as if ``strength`` documents of that had
been seen; the strength of the host level is estimated from the spread between
hosts (method of moments).  A document's log odds are moved by those of its
path's posterior against the global mean.

The classifier is fitted on at most ``SAMPLE`` labelled rows, taken in the order of
a hash of their ids; the aggregates are of all documents.

Defined results: null and empty texts have all counts zero; a null host or path
is a group of its own; null labels are not used; without labels of both kinds
every document gets their mean (0.5 without any) from the classifier; repeated
rows are evidence each; an empty table gives no rows.  Only the named columns are
looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.evidence import level_sums, logit, shrunk
from tickmart.llm.textscan import U64, Words, column_bytes, mix, owners, row_chunks, space_word_table
from tickmart.sinks.tables import stage

SAMPLE = 20_000
PATH_STRENGTH = 5.0     # documents of the host that a path's own are weighed against
WORDS = Words(space_word_table(), seed=3)
FEATURES = ("log_words word_bytes capitals symbols exclaims digits same_as_last distinct "
            "line_breaks symbol_ends long_words").split()


def _class_tables() -> dict[str, np.ndarray]:
    def table(chars: bytes) -> np.ndarray:
        t = np.zeros(256, bool)
        t[list(chars)] = True
        return t

    return {"capitals": table(bytes(range(65, 91))), "letters": table(bytes([*range(65, 91), *range(97, 123)])),
            "symbols": table(b"#$%&*+/<=>@[\\]^_`{|}~"), "exclaims": table(b"!"),
            "digits": table(bytes(range(48, 58))), "line_breaks": table(b"\n")}


TABLES = _class_tables()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each document."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    start, end, h = WORDS.find(data, offsets)
    row = owners(offsets, start)
    words = np.maximum(np.bincount(row, minlength=n), 1)

    def share(table):
        sums = np.concatenate(([0], np.cumsum(table[data])))
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    def per_word(weights):
        return np.bincount(row, weights, n) / words

    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    with np.errstate(over="ignore"):
        first = np.unique(mix(h + row.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True)[1]
    different = np.bincount(row[first], minlength=n) / np.sqrt(words)
    symbol = TABLES["symbols"] | TABLES["exclaims"]
    return np.stack([
        np.log1p(np.bincount(row, minlength=n)), per_word(end - start),
        share(TABLES["capitals"]) / np.maximum(share(TABLES["letters"]), 1e-3), share(TABLES["symbols"]),
        share(TABLES["exclaims"]), share(TABLES["digits"]), per_word(again), np.log1p(different),
        share(TABLES["line_breaks"]), per_word(symbol[data[end - 1]] if len(end) else end),
        per_word(end - start > 25)], axis=1)


def _feature_rows(batches):
    for batch in batches:
        data, offsets = column_bytes(batch.column(batch.num_columns - 1))
        found = [np.zeros((0, len(FEATURES)))]
        for lo, hi in row_chunks(offsets):
            found.append(features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
        values = np.concatenate(found)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(np.ascontiguousarray(values[:, j])) for j in range(len(FEATURES)))],
            names=[*batch.schema.names[:-1], *FEATURES])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression (Newton's method)."""
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return np.zeros(x.shape[1]), float(np.log(p / (1 - p)))
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w, keep = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ centre)


def _strength(hosts: DataFrame, mean: float) -> float:
    """Documents that the global mean is worth: from the spread between hosts."""
    share = F.col("host_p") / F.col("host_n")
    got = hosts.where("host_n >= 5").agg(F.var_samp(share).alias("v"), F.avg(mean * (1 - mean) / F.col("host_n")).alias("noise")).first()
    spread = (got["v"] or 0.0) - (got["noise"] or 0.0)
    return float(np.clip(mean * (1 - mean) / spread - 1, 1.0, 1000.0)) if spread > 0 else 1000.0


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
            sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """doc_id, host, path, p_text (classifier), host_posterior, path_posterior,
    quality (all evidence), kept of every row of ``docs``."""
    rows = stage(docs.select("doc_id", F.col(f"`{host}`").cast("string").alias("host"),
                             F.col(f"`{path}`").cast("string").alias("path"), "text").mapInArrow(
        _feature_rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, host string, path string, "
        + ", ".join(f"{f} double" for f in FEATURES)), "features")
    # Repeated labels of one id count once; a bounded sample of ids reaches the driver.
    chosen = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
              .agg(F.max("quality").alias("label")).orderBy(F.xxhash64("doc_id")).limit(sample))
    known = rows.join(chosen, "doc_id").select("label", *FEATURES).limit(sample).toPandas()
    weights, bias = fit_logistic(known[FEATURES].to_numpy(float), known["label"].to_numpy(float))
    z = sum((F.lit(float(w)) * F.col(f) for w, f in zip(weights, FEATURES, strict=True)), F.lit(bias))
    scored = rows.select("doc_id", "host", "path", (1 / (1 + F.exp(-z))).alias("p"))
    return combined(scored, threshold)


def combined(scored: DataFrame, threshold: float = 0.5, strength: float | None = None) -> DataFrame:
    """The hierarchy over rows (doc_id, host, path, p)."""
    paths = stage(level_sums(scored, ["host", "path"], ["p"], "path_"), "paths")
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_p").alias("host_p"))
    total = hosts.agg(F.sum("host_n"), F.sum("host_p")).first()
    mean = (total[1] or 0.0) / total[0] if total[0] else 0.5
    k = _strength(hosts, mean) if strength is None else strength
    levels = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).select(
        F.col("host").alias("h"), F.col("path").alias("s"), "path_n", "path_p", "host_n", "host_p")
    at_host = shrunk(F.col("host_p"), F.col("host_n"), F.col("p"), F.lit(mean), k)
    at_path = shrunk(F.col("path_p"), F.col("path_n"), F.col("p"), F.col("host_posterior"), PATH_STRENGTH)
    odds: Column = logit(F.col("p")) + logit(F.col("path_posterior")) - logit(F.lit(mean))
    return (scored.join(levels, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("s")))
            .withColumn("host_posterior", at_host).withColumn("path_posterior", at_path)
            .withColumn("quality", 1 / (1 + F.exp(-odds)))
            .select("doc_id", "host", "path", F.col("p").alias("p_text"), "host_posterior", "path_posterior",
                    "quality", (F.col("quality") >= threshold).alias("kept")))
