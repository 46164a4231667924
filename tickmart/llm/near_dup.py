"""MinHash near-dedup (operator 5): signature-coordinate inverted join.

A document's set is its distinct 2-word shingles (``size`` words).  Documents of
one set form a class and only one of them goes on.  Each class has ``COORDINATES``
minima; it is posted under (coordinate, minimum).  Two sets of similarity 0.8
agree in at least ``MATCHES`` of them (missed with a probability of about 1e-6 at exactly 0.8, less above), so
with the values of a signature ordered from rare to common they meet within the
first ``COORDINATES - MATCHES + 1``: only those are posted, and values that one class
alone holds are counted but not posted (prefix).  While lists are merged, pairs
are skipped whose sizes are too far apart, and those whose sketches differ more
than similar sets can: a sketch holds the parity of the shingles of each of
``BITS`` hash values, so it differs in at most as many bits as the sets do in
shingles (of large sets a fixed fraction of the shingles enters, and six standard
deviations are allowed).  Coordinates in which both signatures agree are counted,
and what is left is confirmed on the full sets.

Links only matter as far as they connect.  So each posting list is first joined
with its leaders (two rows a member), and only members still in different components
are then paired with one another: no possible link is left out.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; a text of fewer words than ``size`` is one shingle; rows of one
doc_id are one node whatever their texts, a null doc_id is the smallest and joins no
rows of different texts; repeated rows give repeated results; an empty table gives no rows.  Other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.components import components
from tickmart.llm.textscan import U64, Words, column_bytes, mix, owners, row_chunks, space_word_table
from tickmart.sinks.tables import stage

COORDINATES, MATCHES = 32, 14
PREFIX = COORDINATES - MATCHES + 1
WORDS_64, BITS = 16, 1024       # of a sketch
SKETCHED = 768                  # shingles in a sketch, up to which all of them enter
NULL_ID = -(2**63)
WORDS = Words(space_word_table(), seed=5)
STEP = U64(0x9E3779B97F4A7C15 | 1)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        a = mix(np.arange(1, n + 1, dtype=U64) * STEP)
        return a | U64(1), mix(a + STEP)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, in row order."""
    start, _, h = WORDS.find(data, offsets)
    row = owners(offsets, start)
    joined = np.zeros(len(h), U64)
    for j in range(size):
        joined[: max(0, len(h) - j)] = mix(joined[: max(0, len(h) - j)] * STEP + h[j:])
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n_words) - n_words
    at = np.arange(len(h)) - first[row]
    whole = (n_words[row] > 0) & (at + size <= n_words[row])
    few = np.flatnonzero((n_words > 0) & (n_words < size))  # the whole sequence is one shingle
    hashes, rows = joined[whole], row[whole]
    if len(few):
        short = np.array([mix(np.cumsum(h[first[r]: first[r] + n_words[r]] * STEP, dtype=U64)
                              + U64(n_words[r]))[-1] for r in few], U64)
        hashes, rows = np.concatenate([hashes, short]), np.concatenate([rows, few])
    with np.errstate(over="ignore"):
        _, keep = np.unique(mix(hashes + rows.astype(U64) * STEP), return_index=True)
    rows, hashes = rows[keep], hashes[keep]
    order = np.argsort(rows, kind="stable")
    return rows[order], hashes[order]


def _levels(n):
    """Sets of n shingles enter their sketch with one shingle of 2^level."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / SKETCHED))).astype(np.int64)


def _sketches(row: np.ndarray, h: np.ndarray, level: np.ndarray, n_rows: int) -> np.ndarray:
    """WORDS_64 words a row: the parity of its sampled shingles by hash value."""
    out = np.zeros((n_rows, WORDS_64), U64)
    h = mix(h ^ U64(0xD6E8FEB86659FD93))
    lvl = level[row].astype(U64)
    taken = (h >> U64(40)) & ((U64(1) << lvl) - U64(1)) == 0
    row, h = row[taken], h[taken]
    if len(row):
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        bit, word = U64(1) << (h & U64(63)), (h >> U64(6)) & U64(WORDS_64 - 1)
        for w in range(WORDS_64):
            out[row[begin], w] = np.bitwise_xor.reduceat(np.where(word == U64(w), bit, U64(0)), begin)
    return out


def _lists(values: np.ndarray, kind) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()),
                                    pa.array(np.ascontiguousarray(values).view(kind).ravel()))


def _signature_rows(batches, size: int, percent: int):
    a, b = _seeds(COORDINATES)
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        counts, sums, signs, own_sketch, up_sketch = [], [], [], [], []
        for lo, hi in row_chunks(offsets):
            own = offsets[lo:hi + 1] - offsets[lo]
            row, h = shingles(data[offsets[lo]:offsets[hi]], own, size)
            n = np.bincount(row, minlength=hi - lo)
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            sign = np.zeros((hi - lo, COORDINATES), np.uint32)
            total = np.zeros((hi - lo, 2), U64)
            if len(h):
                held = row[begin]
                total[held, 0] = np.add.reduceat(mix(h), begin)
                total[held, 1] = np.add.reduceat(mix(h ^ STEP), begin)
                for c in range(COORDINATES):
                    sign[held, c] = np.minimum.reduceat(h * a[c] + b[c], begin) >> U64(32)
            level, above = _levels(n), _levels(n * 100 / percent)
            sketch = _sketches(row, h, level, hi - lo)
            upper = sketch.copy()       # as a larger set of similar size would enter
            differs = above > level
            if differs.any():
                more = _sketches(row, h, above, hi - lo)
                upper[differs] = more[differs]
            for parts, x in ((counts, n), (sums, total), (signs, sign), (own_sketch, sketch), (up_sketch, upper)):
                parts.append(x)
        n = np.concatenate([np.zeros(0, np.int64), *counts])
        sums = np.concatenate([np.zeros((0, 2), U64), *sums]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(np.ascontiguousarray(sums[:, 0])),
             pa.array(np.ascontiguousarray(sums[:, 1])), pa.array(_levels(n)),
             _lists(np.concatenate([np.zeros((0, COORDINATES), np.uint32), *signs]), np.int32),
             _lists(np.concatenate([np.zeros((0, WORDS_64), U64), *own_sketch]), np.int64),
             _lists(np.concatenate([np.zeros((0, WORDS_64), U64), *up_sketch]), np.int64)],
            names=["id", "n", "set1", "set2", "level", "sign", "sketch", "upper"])


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def signatures(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """id, n (shingles), set1 and set2 (128-bit hash of the set), level and sketch
    (upper: the sketch at the level of a set of 100 / percent times the size),
    sign (the minima)."""
    return docs.select(_id().alias("id"), "text").mapInArrow(
        lambda it: _signature_rows(it, size, percent),
        "id long, n long, set1 long, set2 long, level long, sign array<int>, sketch array<long>, upper array<long>")


def _postings(classes: DataFrame, least: int) -> DataFrame:
    """key, id, n, weight: the prefix postings of classes of ``least`` shingles or
    more.  The weight, how many classes hold a class's values, is largest for the
    one that the others of a group are copies of."""
    posts = classes.where(F.col("n") >= least).select("id", "n", F.posexplode("sign")).select(
        "id", "n", (F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(
            F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))).alias("key"))
    held = posts.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = posts.join(held, "key")
    # At most COORDINATES entries a class; those it lacks are values of its own, the rarest.
    ordered = shared.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("keys"),
                                            F.sum("df").alias("weight"))
    room = F.lit(PREFIX - COORDINATES) + F.size("keys")
    return (ordered.withColumn("room", room).where("room > 0")
            .select("id", "n", "weight", F.explode(F.slice("keys", 1, F.col("room"))).alias("k"))
            .select(F.col("k.key").alias("key"), "id", "n", "weight"))


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _alike(percent: int) -> Column:
    """May x and y (n of x not above n of y) be similar, as far as sketches tell?"""
    of_x = F.when(F.col("x.level") == F.col("y.level"), F.col("x.sketch")).otherwise(F.col("x.upper"))
    differ = sum((F.bit_count(of_x[i].bitwiseXOR(F.col("y.sketch")[i])) for i in range(WORDS_64)), F.lit(0))
    most = (F.col("x.n") + F.col("y.n")) * F.lit((100 - percent) / (100 + percent))
    taken = most / F.pow(F.lit(2.0), F.col("y.level"))
    return differ <= F.when(F.col("y.level") == 0, most + 1e-6).otherwise(taken + 6 * F.sqrt(taken) + 6)


def _leader_pairs(posts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each member of a posting list with the leaders of its size band: the class
    of the largest weight and the one of the smallest id."""
    banded = posts.withColumn("band", F.floor(F.log("n") / F.log(F.lit(100 / percent))))
    leaders = (banded.groupBy("key", "band")
               .agg(F.min("id").alias("least"), F.max(F.struct("weight", "id")).alias("most"),
                    F.count(F.lit(1)).alias("size"))
               .where("size > 1")
               .select("key", "band", F.explode(F.array_distinct(F.array("least", "most.id"))).alias("b")))
    pairs = (banded.join(leaders, ["key", "band"]).where("id <> b")
             .select(F.col("id").alias("a"), "b").distinct())
    sides = classes.select("id", "n", "level", "sign", "sketch", "upper")
    both = (pairs.join(sides.select(F.col("id").alias("a"), F.struct(*sides.columns).alias("p")), "a")
            .join(sides.select(F.col("id").alias("b"), F.struct(*sides.columns).alias("q")), "b"))
    small_first = F.struct("p.n", "p.id") < F.struct("q.n", "q.id")
    return (both.select(F.when(small_first, F.col("p")).otherwise(F.col("q")).alias("x"),
                        F.when(small_first, F.col("q")).otherwise(F.col("p")).alias("y"))
            .where(_similar_sizes(F.col("x.n"), F.col("y.n"), percent) & _alike(percent) & _agree())
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))


def _agree() -> Column:
    """Do the signatures agree in MATCHES coordinates or more?"""
    same = F.zip_with("x.sign", "y.sign", lambda p, q: p == q)
    return F.size(F.filter(same, lambda t: t)) >= MATCHES


def _cross_pairs(posts: DataFrame, classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of one posting list in different components that may be similar."""
    named = posts.join(labels, posts["id"] == labels["node"], "left").select(
        "key", "id", F.coalesce("component", "id").alias("component"))
    mixed = (named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("key"))
    sides = classes.select("id", "n", "level", "sign", "sketch", "upper")
    opened = stage(named.join(mixed, "key", "left_semi").join(sides, "id"), "open-postings")
    x, y = opened.alias("x"), opened.alias("y")
    return (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
                   & (F.struct("x.n", "x.id") < F.struct("y.n", "y.id"))
                   & _similar_sizes(F.col("x.n"), F.col("y.n"), percent) & _alike(percent) & _agree())
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())


def _confirm(batches, size: int, percent: int):
    for batch in batches:
        a, b, ta, tb = batch.columns
        keep = []
        (da, oa), (db, ob) = column_bytes(ta), column_bytes(tb)
        for i in range(batch.num_rows):
            sets = [shingles(d[o[i]:o[i + 1]], np.array([0, o[i + 1] - o[i]]), size)[1] for d, o in ((da, oa), (db, ob))]
            both = len(np.intersect1d(*sets, assume_unique=True))
            keep.append(100 * both >= percent * (len(sets[0]) + len(sets[1]) - both))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    texts = docs.select(_id().alias("id"), "text")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
            .mapInArrow(lambda it: _confirm(it, size, percent), "a long, b long"))


def _one_id_links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes in which the rows of one doc_id are (few ids have several texts)."""
    own = rows.where((F.col("n") > 0) & (F.col("id") != NULL_ID)).select("id", "set1", "set2", "n")
    whole = F.struct("set1", "set2", "n")
    several = own.groupBy("id").agg(F.min(whole).alias("lo"), F.max(whole).alias("hi")).where("lo <> hi").select("id")
    named = (own.join(several, "id", "left_semi")
             .join(classes.select("set1", "set2", "n", F.col("id").alias("b")), ["set1", "set2", "n"]).select("id", "b").distinct())
    return (named.join(named.groupBy("id").agg(F.min("b").alias("a")), "id").where("a <> b").select("a", "b"))


def near_groups(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """id, n, component of every row of ``docs`` (id: doc_id, null as the least long)."""
    rows = stage(signatures(docs, size, percent), "signatures")
    marks = ["level", "sign", "sketch", "upper"]
    classes = stage(rows.where("n > 0").groupBy("set1", "set2", "n")
                    .agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in marks)), "classes")
    # Of sets of k shingles, two different ones can at best share k of k + 1.
    least = -(-percent // (100 - percent))
    posts = stage(_postings(classes, least), "postings")
    links = stage(_one_id_links(rows, classes), "one-id-links")
    labels = components(links) if not links.isEmpty() else docs.sparkSession.createDataFrame([], "node long, component long")
    for joined in (False, True):
        pairs = stage(_cross_pairs(posts, classes, labels, percent) if joined
                      else _leader_pairs(posts, classes, percent), "pairs")
        if pairs.isEmpty():
            continue
        found = stage(_confirmed(pairs, docs, size, percent), "links")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
    known = (classes.join(labels, classes["id"] == labels["node"], "left")
             .select("set1", "set2", "n", F.coalesce("component", "id").alias("component")))
    return (rows.select("id", "n", "set1", "set2").join(known, ["set1", "set2", "n"], "left")
            .select("id", "n", F.coalesce("component", "id").alias("component")))


def near_dedup(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    def back(c):
        return F.when(F.col(c) != NULL_ID, F.col(c))

    return near_groups(docs, size, percent).select(
        back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group (the one of the smallest id), all
    columns kept."""
    gone = stage(near_groups(docs, size, percent).where("id <> component")
                 .select(F.col("id").alias("_gone_id")).distinct(), "near-copies")
    keyed = docs.withColumn("_row_id", _id())
    return (keyed.join(gone, keyed["_row_id"] == gone["_gone_id"], "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
