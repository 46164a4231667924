"""Toxicity (operator 11): a weighted lexicon matched by Aho-Corasick.

Texts are folded first: letters of other scripts that look Latin become Latin,
compatibility forms (full width, mathematical) and stacked marks go, and digits and
signs that stand for letters become them (``1``, ``!``, ``i`` and ``l`` are one letter,
as ``1`` stands for either).  Accented letters that a language has stay.  A number
alone stays a number.  What is left is the words of letters and digits, one space
apart, and one automaton over `` word ``, `` stem`` and `` exception phrase `` finds all in
one pass.  A word counts once, with its largest weight; one inside an exception
phrase does not count.  The summed weights, and the sums by length, go into a
logistic score.

The lexicon is learnt from labelled rows of the ids given as usable.  Entries are
words, and stems (the first STEM letters of at least STEM_WORDS different words).  An
entry's weight is the log ratio of its rates in toxic and other texts.  It is taken if
its toxic share can't be chance (the Chernoff bound, over all entries tested, is under
``CHANCE``) and its weight is ``LEAST_WEIGHT`` at least.  Both its texts and its different
surroundings (word before, word after) must bear that out, so that the rare words
of one passage copied many times are no entries.  Exception phrases are two words,
one of them an entry, that have ``EXCEPTION_TEXTS`` different surroundings in texts that
aren't toxic, and none in toxic ones.  Learning uses at most ``SAMPLE`` labelled ids
(the smallest hashes of the id); counting is Spark's grouped sums.  Every row is
scored, whole.

Defined results: null and empty texts have no words and get the score of texts without
a match; several labels of one id count as toxic if one of them is; a null id is never
learnt from and not held out; equal texts are learnt from once (as toxic if half of
their rows are); repeated rows are scored each; without labels of both kinds there is
no lexicon and every score is their mean (0 without any); an empty table gives no rows.
Only the named columns are looked at.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.quality import fit_logistic
from tickmart.sinks.tables import stage

SAMPLE = 60_000         # labelled ids that are learnt from
TERMS = 20_000          # entries, and exception phrases, at most: the strongest
STEM = range(4, 8)      # letters of a stem
STEM_WORDS = 3
CHANCE = 0.1            # entries expected by chance, over all words tested
LEAST_WEIGHT = 2.0
EXCEPTION_TEXTS = 3
THRESHOLD = 0.3

# Letters of other scripts by the Latin letter that they look like (fixed values).
LOOK_ALIKES = {
    "a": "аαɑ", "b": "ЬВвβ", "c": "сϲᴄ", "d": "ԁɗ", "e": "еεҽ", "f": "ƒ", "g": "ɡց", "h": "һнհ",
    "i": "іιıӏ", "j": "јϳ", "k": "кκ", "l": "ⅼӀ", "m": "мμᴍ", "n": "пηո", "o": "оοσօᴏ", "p": "рρ",
    "q": "ԛզ", "r": "гᴦ", "s": "ѕꜱ", "t": "тτᴛ", "u": "υսᴜ", "v": "ѵνᴠ", "w": "ѡωԝᴡ", "x": "хχ",
    "y": "уγүʏ", "z": "ᴢʐ",
}
# Digits and signs by the letter that they stand for (fixed values).
DIGITS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "l"}
# Letters that one digit may stand for count as one.
SAME = {"i": "l"}

NUMBER = re.compile(r"(?<![^\W_])\d+(?![^\W_])")
SIGN = re.compile(r"[@$!](?=[^\W_])")
WORD = re.compile(r"[^\W_]+")


class Folding(dict):
    """Code point -> folded string, worked out once for each."""

    def __init__(self):
        super().__init__()
        looks = {look: letter for letter, all_of in LOOK_ALIKES.items() for look in all_of}
        self.latin = {c.lower(): letter for c, letter in looks.items()} | looks

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        # Marks left after composition, zero-width characters and soft hyphens go.
        out = "" if unicodedata.category(ch) in ("Cf", "Mn", "Me") else "".join(
            self.latin.get(c) or self.latin.get(c.lower(), c.lower()) for c in unicodedata.normalize("NFKC", ch))
        out = "".join(SAME.get(c, c) for c in "".join(DIGITS.get(c, c) for c in out))
        self[code] = out
        return out


FOLDING = Folding()


def folded(text: str) -> str:
    """The words of a text, folded, each with a space before it and one at the end."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    text = NUMBER.sub(" 2 ", text)
    text = SIGN.sub(lambda m: SIGNS[m.group()], text)
    words = WORD.findall(text.translate(FOLDING))
    return " " + " ".join(words) + " " if words else " "


@dataclass
class Lexicon:
    """Folded words and stems with weights, and phrases in which they are innocent."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)

    def automaton(self):
        """Automaton over `` word ``, `` stem`` and `` exception phrase ``; None without entries."""
        if not self.words and not self.stems:
            return None
        found = ahocorasick.Automaton()
        for stem, weight in self.stems.items():
            found.add_word(f" {stem}", (len(stem) + 1, stem + "*", weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None, 0.0))
        for word, weight in self.words.items():
            found.add_word(f" {word} ", (len(word) + 2, word, weight))
        found.make_automaton()
        return found


def occurrences(automaton, words: str) -> list[tuple[int, str, float]]:
    """(start, entry, weight) of every entry found outside exception phrases."""
    if automaton is None:
        return []
    hits, innocent = [], []
    for last, (size, entry, weight) in automaton.iter(words):
        if entry is None:
            innocent.append((last + 1 - size, last))
        else:
            hits.append((last + 1 - size, last, entry, weight))
    if innocent:
        innocent.sort()
        starts = [a for a, _ in innocent]
        ends = np.maximum.accumulate([b for _, b in innocent])
        at = np.searchsorted(starts, [h[0] for h in hits], side="right") - 1
        hits = [h for h, k in zip(hits, at, strict=True) if k < 0 or ends[k] < h[1]]
    return [(start, entry, weight) for start, _, entry, weight in hits]


def matches(automaton, words: str) -> list[tuple[int, str, float]]:
    """The strongest entry of each word that has one."""
    best: dict[int, tuple[int, str, float]] = {}
    for hit in occurrences(automaton, words):
        if hit[0] not in best or best[hit[0]][2] < hit[2]:
            best[hit[0]] = hit
    return list(best.values())


def evidence(hits, n_words: int) -> tuple[float, float, float]:
    """What the score is made of: any match, summed weight, weight by length."""
    total = sum(w for _, _, w in hits)
    return float(total > 0), float(np.log1p(total)), float(np.log1p(100 * total / max(n_words, 1)))


def labelled(docs: DataFrame, labels: DataFrame, usable, sample: int = SAMPLE) -> DataFrame:
    """label, words (folded) of the different texts of at most ``sample`` usable ids."""
    kind = docs.schema["doc_id"].dataType
    chosen = stage(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable(F.col("doc_id")))
                   .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("label"))
                   .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
                   .select(F.col("doc_id").cast(kind).alias("doc_id"), "label"), "chosen")

    def fold(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([folded(t or "") for t in batch.column(1).to_pylist()], pa.string())],
                names=["label", "words"])

    # At most ``sample`` ids and labels: bounded, whatever the tables hold.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    return stage(texts.mapInArrow(fold, "label int, words string").groupBy("words")
                 .agg((F.avg("label") >= 0.5).cast("int").alias("label")), "labelled")


def _surprise(toxic, n, share: float):
    """Log of one over the chance bound: n texts, ``toxic`` of them toxic, where
    ``share`` is expected (Chernoff)."""
    p = F.least(toxic / n, F.lit(1 - 1e-12))
    return F.when(p > share, toxic * F.log(p / share) + (n - toxic) * F.log((1 - p) / (1 - share))).otherwise(0.0)


def _stems(words: str, size: int):
    """``stem*`` of every word of ``size`` letters or more."""
    long = F.filter(words, lambda w: F.char_length(w) >= size)
    return F.transform(long, lambda w: F.concat(F.substring(w, 1, size), F.lit("*")))


def learn(texts: DataFrame, terms: int = TERMS) -> Lexicon:
    """The lexicon from rows (label, words)."""
    total = texts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t")).first()
    n, t = total["n"], total["t"] or 0
    if not 0 < t < n:
        return Lexicon()
    share = t / n
    words = F.array_distinct(F.split(F.trim("words"), " "))
    entries = F.array_distinct(F.concat("w", *(_stems("w", k) for k in STEM)))
    counts = stage(texts.select("label", words.alias("w")).select("label", F.explode(entries).alias("entry"))
                   .where("entry <> ''").groupBy("entry")
                   .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).where("n >= 3"), "entries")
    bar = float(np.log(max(counts.count(), 1) / CHANCE))

    def weight(toxic, others):
        return F.log((toxic + 0.5) / (t + 1)) - F.log((others + 0.5) / (n - t + 1))

    strong = (counts.withColumn("surprise", _surprise(F.col("toxic"), F.col("n"), share))
              .where((F.col("surprise") > bar) & (weight(F.col("toxic"), F.col("n") - F.col("toxic")) >= LEAST_WEIGHT / 2))
              .orderBy(F.desc("surprise"), "entry").limit(terms).collect())
    held = {r["entry"]: (r["toxic"], r["n"] - r["toxic"]) for r in strong}
    candidates = Lexicon({e: 1.0 for e in held if e[-1] != "*"}, {e[:-1]: 1.0 for e in held if e[-1] == "*"})

    def surroundings(batches):
        automaton = candidates.automaton()
        for batch in batches:
            rows = []
            for label, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start, entry, _ in occurrences(automaton, words):
                    end = words.index(" ", start + 1)
                    before = words[words.rfind(" ", 0, start) + 1:start] if start else ""
                    after = words[end + 1:words.find(" ", end + 1)] if end + 1 < len(words) else ""
                    rows.append((entry, words[start + 1:end], before, after, label))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.string() if k < 4 else pa.int32()) for k in range(5)],
                names=["entry", "word", "before", "after", "label"])

    places = stage(texts.select("label", "words").mapInArrow(surroundings, "entry string, word string, before string, after string, label int")
                   .groupBy("entry", "word", "before", "after").agg(F.max("label").alias("toxic")), "surroundings")

    def innocent(side, phrase):
        return (places.where(F.length(side) > 0).groupBy("word", side)
                .agg(F.max("toxic").alias("toxic"), F.countDistinct("before", "after").alias("n"), F.first(phrase).alias("phrase"))
                .where((F.col("toxic") == 0) & (F.col("n") >= EXCEPTION_TEXTS)).select("word", "phrase", "n"))

    around = {"before": F.concat_ws(" ", "before", "word"), "after": F.concat_ws(" ", "word", "after")}
    phrases = (innocent("before", around["before"]).unionByName(innocent("after", around["after"]))
               .orderBy(F.desc("n"), "phrase").limit(terms).collect())
    # At most 2 * terms short rows.
    excused = texts.sparkSession.createDataFrame([(r["phrase"],) for r in phrases], "phrase string")
    counted = places
    for phrase in around.values():
        counted = counted.join(F.broadcast(excused), phrase == F.col("phrase"), "left_anti")
    by_entry = (counted.groupBy("entry", "word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("others"))
                .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others"),
                                      F.sum((F.col("toxic") > 0).cast("int")).alias("words")).collect())
    spared = {r["word"] for r in phrases}
    weights = {}
    for r in by_entry:
        entry, stem = r["entry"], r["entry"][-1] == "*"
        toxic, others = held[entry]
        excepted = any(w.startswith(entry[:-1]) for w in spared) if stem else entry in spared
        toxic, others = min(toxic, r["toxic"]), r["others"] if excepted else max(others, r["others"])
        p = min(toxic / max(toxic + others, 1), 1 - 1e-12)
        if p <= share or toxic * np.log(p / share) + others * np.log((1 - p) / (1 - share)) <= bar:
            continue
        w = float(np.log((toxic + 0.5) / (t + 1)) - np.log((others + 0.5) / (n - t + 1)))
        if w >= LEAST_WEIGHT and (not stem or r["words"] >= STEM_WORDS):
            weights[entry] = w
    stems = {e[:-1]: w for e, w in weights.items() if e[-1] == "*"}
    # An entry that begins with a stem of no less weight adds nothing.
    needed = {e: w for e, w in weights.items()
              if all(stems.get(e[:k], -1.0) < w for k in STEM if k < len(e.rstrip("*")) + (e[-1] != "*"))}
    lexicon = Lexicon({e: w for e, w in needed.items() if e[-1] != "*"}, {e[:-1]: w for e, w in needed.items() if e[-1] == "*"})
    lexicon.exceptions = sorted({r["phrase"] for r in phrases
                                 if r["word"] in lexicon.words or any(r["word"][:k] in lexicon.stems for k in STEM)})
    return lexicon


def _evidence_rows(lexicon: Lexicon):
    def run(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            found = [(label, *evidence(matches(automaton, words), words.count(" ") - 1))
                     for label, words in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in found], pa.int32())] + [pa.array([r[k] for r in found], pa.float64()) for k in (1, 2, 3)],
                names=["label", "hit", "total", "density"])
    return run


def calibrate(texts: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, float]:
    """Weights and bias of the score from the evidence of the learnt rows (at most a
    few numbers for each of the sample); more evidence never lowers a score."""
    known = texts.select("label", "words").mapInArrow(_evidence_rows(lexicon), "label int, hit double, total double, density double").toPandas()
    if not len(known):
        return np.zeros(3), -np.inf
    x, y = known[["hit", "total", "density"]].to_numpy(float), known["label"].to_numpy(float)
    if y.min() == y.max():
        return np.zeros(3), float(np.inf if y[0] else -np.inf)
    use = x.std(0) > 0
    while use.any():
        weights, bias = fit_logistic(x[:, use], y)
        if (weights >= 0).all():
            break
        use[np.flatnonzero(use)[weights.argmin()]] = False
    out = np.zeros(3)
    if use.any():
        out[use] = weights
    else:
        bias = float(np.log(y.mean() / (1 - y.mean())))
    return out, bias


def toxicity(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray, bias: float, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, terms (entries found), weight, score, predicted."""
    def score(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            counts, terms, sums, scores = [], [], [], []
            for value in batch.column(1):
                words = folded(value.as_py() or "")
                hits = matches(automaton, words)
                counts.append(words.count(" ") - 1)
                terms.append(sorted({w for _, w, _ in hits}))
                sums.append(sum(w for _, _, w in hits))
                z = float(np.dot(weights, evidence(hits, counts[-1]))) + bias
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -700, 700)))) if np.isfinite(bias) else float(bias > 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(terms, pa.list_(pa.string())),
                 pa.array(sums, pa.float64()), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "n_words", "terms", "weight", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {kind}, n_words long, terms array<string>, weight double, score double, predicted int")


def held_out(doc_id):
    """Rows that nothing is learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Lexicon and score learnt from ``labels.toxic`` of the rows that aren't held out,
    applied to every row of ``docs``."""
    texts = labelled(docs, labels, lambda doc_id: ~held_out(doc_id), sample)
    lexicon = learn(texts)
    weights, bias = calibrate(texts, lexicon)
    scored = toxicity(docs, lexicon, weights, bias)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                         "n_words", F.size("terms").alias("n_terms"), "weight")
