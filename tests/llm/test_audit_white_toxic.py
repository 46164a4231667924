"""Toxicity, whitening and the filter audit against brute force in plain Python, on
tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("tickmart.llm")
from tickmart.llm import filter_audit, toxicity, whitening  # noqa: E402
from tickmart.llm.runtime import prepare  # noqa: E402

SPACE = " \t\n\x0b\x0c\r"


# ---- filter audit -------------------------------------------------------------------

def audit_table():
    rnd = random.Random(11)
    texts = [None, "", " \t", "short", "A" * 60, "# " * 70, "a b " * 90, "é" * 40 + " Ü x y"]
    for _ in range(60):
        n = rnd.choice([5, 49, 50, 51, 120])
        words = [rnd.choice(["alpha", "Beta", "GAMMA", "x|y", "it's", "die", "50%"]) + str(rnd.randint(0, rnd.choice([3, 500])))
                 for _ in range(n)]
        texts.append(rnd.choice([" ", "\n", " \x0b"]).join(words))
    texts += texts[5:25] + texts[:3]
    texts.append(" ".join(f"w{i}" for i in range(60000)))
    rows = [(i * 7 % 1009, t, rnd.choice(["s1", "s2", "", None, "S1"])) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, texts[9], "s1"), (None, texts[9], "s1"), (rows[9][0], texts[9], "s2"), (None, None, None)]
    labels = [(d, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for d, _, _ in rows[:70]]
    labels += [(rows[3][0], 1, 0), (rows[3][0], 0, 1), (None, 1, 1), (5555, 1, 1)]
    return rows, labels


def words_of(text):
    out, word = [], ""
    for ch in text + " ":
        if ch in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += ch
    return out


def brute_audit(rows, labels):
    good, bad = {}, {}
    for d, q, t in labels:
        if d is not None:
            good[d] = good.get(d, False) or q == 1
            bad[d] = bad.get(d, False) or t == 1
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    parts = {}
    for d, t, s in rows:
        t, w = t or "", words_of(t or "")
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and d > first[t]}
        parts.setdefault(s or "", []).append((fails, good.get(d, False), bad.get(d, False)))
    out = []
    for part, held in parts.items():
        some = []
        for order in itertools.permutations("ABCDE"):
            left = held
            for k, f in enumerate(order):
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                some.append((part, "".join(order), k + 1, len(left), len(gone), sum(x[0][f] for x in held) - len(gone),
                             sum(x[0][f] and sum(x[0].values()) == 1 for x in held), sum(x[1] for x in gone),
                             sum(x[2] for x in gone), f))
        total = {f: sum(r[4] for r in some if r[9] == f) for f in "ABCDE"}
        out += [(*r[:9], total[r[9]]) for r in some]
    return sorted(out)


def test_filter_audit(spark):
    prepare(spark)
    rows, labels = audit_table()
    docs = spark.createDataFrame([(*r, "p", 1, "x") for r in rows], "doc_id long, text string, source string, part string, mask int, sha string")
    marks = spark.createDataFrame([(*r, "p") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.filter_audit(docs.repartition(3), marks)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, labels)
    assert filter_audit.filter_audit(docs.limit(0), marks).count() == 0
    bare = filter_audit.filter_audit(docs, marks.limit(0)).collect()
    assert len(bare) == 4 * 600 and not any(r.good_lost or r.toxic_lost for r in bare)


@pytest.mark.parametrize("n", range(1, 7))
def test_swaps_reach_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for level in filter_audit.adjacent_swaps(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n) == len(filter_audit.adjacent_swaps(n)) + 1


def test_diagram_shares_equal_parts():
    # All masks alike: one node a level.
    d = filter_audit.Diagram({m: (1, 0, 0) for m in range(32)})
    assert len(d.nodes) == 6 and d.total(d.root)[0] == 32
    for level in filter_audit.adjacent_swaps(5):
        d.swap(level)
    assert d.total(d.root)[0] == 32 and [s[2][0] for s in d.steps()] == [16, 8, 4, 2, 1]


# ---- whitening ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, x string, n string"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], v, 0, "x", "n") for i, v in enumerate(vectors)], VECTORS)


def brute_white(vectors, components=16):
    """Exact integers; eigenvectors by a dense solver."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in enumerate(vectors)
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1][:components], vectors_[:, ::-1][:, :components], float(np.trace(centred.T @ centred / n))


def check_white(rows, vectors):
    kept, n, sums, values, axes, trace = brute_white(vectors)
    rank = int((values > 1e-9 * values[0]).sum())
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert sorted(got) == sorted(i for i, _ in kept)
    signs = [0.0] * rank
    for i, x in kept:
        centred = np.array([float(n * a - s) / n for a, s in zip(x, sums)])
        assert sorted(got[i]) == list(range(1, rank + 1))
        for k in range(rank):
            (r,) = got[i][k + 1]
            want = centred @ axes[:, k] / math.sqrt(values[k])
            if not signs[k] and abs(want) > 1e-6:
                signs[k] = math.copysign(1.0, want * r.whitened)
            assert r.whitened * (signs[k] or 1.0) == pytest.approx(want, abs=1e-8)
            assert (r.n, r.deviation) == (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)))
            assert r.explained == pytest.approx(values[k] / trace, rel=1e-9) and 0 <= r.identity_error < 1e-9


def test_whitening(spark):
    prepare(spark)
    rnd = np.random.default_rng(4)
    base = (rnd.normal(size=(300, 20)) * np.linspace(2.0, 0.3, 20)).tolist()
    vectors = base + base[:40] + [base[0]] * 50
    vectors += [None, [None] * 20, [float("nan")] + [0.0] * 19, [0.0] * 19 + [float("inf")], base[1][:5] + [None] + base[1][6:]]
    df = frame(spark, vectors).repartition(5)
    check_white(whitening.whiten(df).collect(), vectors)


def test_whitening_of_low_rank_and_odd_tables(spark):
    prepare(spark)
    flat = [[0.5 * a, -1.0 * a, 0.25 * b] for a in range(6) for b in range(5)]
    check_white(whitening.whiten(frame(spark, flat)).collect(), flat)
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [None, [None]])).count() == 0
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 9)).count() == 0       # one distinct vector: no rank
    assert whitening.whiten(frame(spark, [[], []])).count() == 0
    ragged = [[1.0, 0.0], [0.0, 1.0], [0.5, 0.25], [1.0, 2.0, 3.0], []]
    rows = whitening.whiten(frame(spark, ragged)).collect()
    assert {r.vec_id for r in rows} == {0, 1, 2} and len(rows) == 6
    huge = [[3e38, 0.0], [-3e38, 1.0], [0.0, 2.0]] * 2
    rows = whitening.whiten(frame(spark, huge, [7, 7, None, 8, 9, None])).collect()
    assert len(rows) == 6 and all(r.n == 3 for r in rows) and sum(r.vec_id is None for r in rows) == 2
    assert all(r.deviation is None for r in rows if r.vec_id == 8)


def test_factorisations():
    rnd = np.random.default_rng(1)
    for shape in ((1, 1), (5, 5), (12, 4), (33, 33)):
        half = rnd.normal(size=shape)
        v = half @ half.T
        factor = whitening.pivoted_cholesky(v)
        assert factor.shape[1] == shape[1] and np.allclose(factor @ factor.T, v)
        values, axes = whitening.jacobi_columns(factor)
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:shape[1]], rtol=1e-10)
        assert np.allclose(v @ axes, axes * values) and np.allclose(axes.T @ axes, np.eye(shape[1]))
    for n in (2, 3, 6, 7):
        met = [tuple(p) for r in whitening._rounds(n) for p in r.T.tolist()]
        assert sorted(met) == list(itertools.combinations(range(n), 2))


# ---- toxicity -----------------------------------------------------------------------

def brute_fold(text):
    """Folding, written as one walk over the characters."""
    import unicodedata

    looks = {c: k for k, v in toxicity.LOOK_ALIKES.items() for c in v}
    letters = []
    for ch in unicodedata.normalize("NFC", text):
        if unicodedata.category(ch) not in ("Cf", "Mn", "Me"):
            letters.append(ch)
    words, word = [], ""
    stream = [*letters, " "]
    for k, ch in enumerate(stream):
        if ch.isalnum() or (ch in "@$!" and k + 1 < len(letters) and letters[k + 1].isalnum()):
            word += ch
            continue
        if word:
            words.append(word)
        word = ""
    out = []
    for w in words:
        if w.strip("@$!").isdigit():
            out.append("2")
            continue
        made = ""
        for ch in w:
            ch = toxicity.SIGNS.get(ch, ch)
            for c in unicodedata.normalize("NFKC", ch):
                c = looks.get(c) or looks.get(c.lower()) or c.lower()
                made += "l" if toxicity.DIGITS.get(c, c) == "i" else toxicity.DIGITS.get(c, c)
        out.append(made)
    return " " + "".join(w + " " for w in out)


def test_folding():
    plain = toxicity.folded("you idiot, worthless")
    for other in ("you 1d10t, w0rth1ess", "yоu іdіоt... wοrthlеss", "YOU !diot w0rthle$s", "y​ou i­diot worthless",
                  "ｙｏｕ ｉｄｉｏｔ 𝐰𝐨𝐫𝐭𝐡𝐥𝐞𝐬𝐬", "you i҉diot worthless!"):
        assert toxicity.folded(other) == plain, other
    assert toxicity.folded("in 1999 and 455") == " ln 2 and 2 "
    assert toxicity.folded("") == toxicity.folded(" .,") == " "
    assert toxicity.folded("réeux Ö vequé") == " réeux ö vequé "
    for text in ("plain words here", "m1xed 12 a3 $5 x!y Ünï été", "пример слов", "tail@", "@start 9"):
        assert toxicity.folded(text) == brute_fold(text), text


def test_matching():
    lexicon = toxicity.Lexicon({"clown": 2.0, "trash": 3.0}, {"lowe": 4.0}, ["class clown", "trash can"])
    auto = lexicon.automaton()

    def hits(text):
        return sorted(w for _, w, _ in toxicity.matches(auto, toxicity.folded(text)))

    assert hits("you clown clown, trash") == ["clown", "clown", "trash"]
    assert hits("the class clown") == [] and hits("class clown clown") == ["clown"]
    assert hits("a trash can of trash") == ["trash"] and hits("clowns trashy") == []
    assert hits("loweisch flower lowe") == ["lowe*", "lowe*"] and hits("") == []
    assert toxicity.matches(toxicity.Lexicon().automaton(), " a ") == []
    assert toxicity.evidence([], 0) == (0.0, 0.0, 0.0)


def brute_matches(lexicon, words):
    """Entries by direct comparison, word by word."""
    held = words.split()
    out = []
    for k, w in enumerate(held):
        pairs = [" ".join(held[j:j + 2]) for j in (k - 1, k) if j >= 0]
        found = [lexicon.words.get(w, 0.0)] + [v for s, v in lexicon.stems.items() if w.startswith(s)]
        if max(found) > 0 and not any(p in lexicon.exceptions for p in pairs):
            out.append(max(found))
    return out


def made_documents(rnd, n=900):
    clean = [f"word{i}" for i in range(400)] + ["bin", "class"]
    bad, stem = ["nastyone", "vilething", "awfulman"], [f"zzqv{x}" for x in ("abe", "ol", "upa", "ener", "ish")]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(clean) for _ in range(rnd.randint(8, 80))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(bad) if i % 2 else rnd.choice(stem))
        elif i % 20 == 0:
            at = rnd.randint(0, len(words))
            words[at:at] = [rnd.choice(clean), "harmless", "vilething", rnd.choice(clean)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    # One passage copied into many toxic texts: its rare words are no entries.
    passage = "quux corge grault garply waldo fred plugh xyzzy"
    rows += [(5000 + i, passage + " nastyone" + " pad" * i) for i in range(30)]
    labels += [(5000 + i, 1) for i in range(30)]
    return rows, labels


def test_toxicity(spark):
    prepare(spark)
    rnd = random.Random(2)
    rows, labels = made_documents(rnd)
    disguised = [(8001, "such a n4sty0ne here"), (8002, "ｖｉｌｅｔｈｉｎｇ"), (8003, "zzqvnew and аwfulmаn"), (8004, "word1 harmless vilething word2"),
                 (8005, "quux corge grault"), (8006, None), (8007, ""), (8007, ""), (None, "nastyone"), (8008, "word1 " * 30000 + "awfulman vilething")]
    docs = spark.createDataFrame([(*r, "t", "w", 1) for r in rows + disguised], "doc_id long, text string, label string, words string, score int")
    marks = spark.createDataFrame([(d, 1, t) for d, t in labels] + [(None, 1, 1), (3, 0, None), (9999, 0, 1), (0, 0, 0)],
                                  "doc_id long, quality int, toxic int")
    held = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 4 == 2}
    texts = toxicity.labelled(docs, marks, lambda d: ~toxicity.held_out(d))
    assert {r.words for r in texts.collect()} == {toxicity.folded(t) for d, t in rows if d not in held}
    lexicon = toxicity.learn(texts)
    assert {"nastyone", "awfulman"} <= set(lexicon.words) and any(s.startswith("zzqv") for s in lexicon.stems)
    assert "harmless vllethlng" in lexicon.exceptions and not {"quux", "corge", "plugh"} & set(lexicon.words)
    weights, bias = toxicity.calibrate(texts, lexicon)
    got = {}
    for r in toxicity.labelled_toxicity(docs.repartition(4), marks).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(disguised)
    truth = dict(labels)
    for d, t in rows + disguised:
        found = brute_matches(lexicon, toxicity.folded(t or ""))
        n = len(toxicity.folded(t or "").split())
        z = bias + weights @ np.array([float(bool(found)), math.log1p(sum(found)), math.log1p(100 * sum(found) / max(n, 1))])
        for r in got[d]:
            assert r.score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9) and r.predicted == int(r.score >= 0.3)
            assert r.n_words == n and r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2)
    wrong = [d for d in held if got[d][0].predicted != truth[d]]
    assert len(wrong) <= 0.03 * len(held)
    assert [got[d][0].predicted for d in range(8001, 8009)] == [1, 1, 1, 0, 0, 0, 0, 1]


def test_toxicity_of_odd_tables(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    labels = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], labels)
    assert [r.score for r in toxicity.labelled_toxicity(docs, none).collect()] == [0.0] * 3
    all_bad = spark.createDataFrame([(1, 0, 1), (2, 0, 1)], labels)
    usable = [d for d in (1, 2) if zlib.crc32(str(d).encode()) % 4 != 2]
    assert {r.score for r in toxicity.labelled_toxicity(docs, all_bad).collect()} == {1.0 if usable else 0.0}
    assert toxicity.labelled_toxicity(docs.limit(0), all_bad).count() == 0
