"""The operators against brute force on a small table with nulls, empty and long
texts, ties, repeated rows, and extra columns whose names the operators use."""

import hashlib
import html as htmllib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tickmart.llm")
from tickmart.llm import (byte_bpe, columnwise, decontaminate, exact_dedup, html_main, langid, line_dedup,  # noqa: E402
                          near_dup, quality, sorted_runs, suffix_dedup, token_counts)
from tickmart.llm.queries import vocabulary  # noqa: E402
from tickmart.llm.runtime import prepare  # noqa: E402

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, owner string, kept string, "
          "id string, key string, n long, place long, text_key string, h string, host string")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def make_rows():
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma", "déjà", "x1", "omega-", "the", "of", "Δ", "it's", "zz9", "lorem"]
    line = "A common line that many documents share, here."
    texts = [None, "", " \t\n", "word", "Two words", line, line.upper(), "\n" + line + " \n\n"]
    base = [" ".join(rnd.choice(words) + str(rnd.randint(0, 400)) for _ in range(rnd.randint(20, 120)))
            for _ in range(12)]
    for b in base:
        w = b.split()
        texts += [b, b, b.replace(" ", "\n", 3) + "\n" + line]
        for k in (1, 2, 9):
            v = list(w)
            for _ in range(k):
                v[rnd.randrange(len(v))] = "changed%d" % rnd.randint(0, 99)
            texts.append(" ".join(v))
    texts.append(" ".join(rnd.choice(words) + str(rnd.randint(0, 3000)) for _ in range(9000)))
    texts.append(texts[-1][5000:30000] + "\x00 tail" + "é" * 300)
    rows = [(i, t, "en", "h%d" % (i % 3)) for i, t in enumerate(texts)]
    rows += [(None, base[0], None, None), rows[20], rows[20], (900, None, None, "h1")]
    return [(d, t, g, s, None, "o", "k", "i", "q", 1, 2, "tk", "h", "hh") for d, t, g, s in rows]


ROWS = make_rows()
PAIRS = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def rank(d):
    return -1 if d is None else d


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def expect(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_exact(docs, empty):
    held = {}
    for d, t in PAIRS:
        held.setdefault(t or "", []).append(d)
    want = []
    for d, t in PAIRS:
        same = held[t or ""]
        keep = max(same, key=rank)
        want.append((d, keep, len(same), d == keep, sha((t or "").encode())))
    assert result(exact_dedup.exact_dedup(docs)) == expect(want)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted(held)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0


def brute_lines(pairs, chars, least):
    keys = {}
    split = [(d, [(x, x.strip(SPACE).translate(FOLD)) for x in (t or "").split("\n")]) for d, t in pairs]
    for d, lines in split:
        for _, k in lines:
            if len(k) >= chars:
                keys.setdefault(k, set()).add(rank(d))
    out = []
    for d, lines in split:
        kept = [x for x, k in lines if not (len(k) >= chars and len(keys[k]) >= least and max(keys[k]) != rank(d))]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


def test_lines(docs, empty):
    assert result(line_dedup.line_dedup_digests(docs)) == expect(brute_lines(PAIRS, 20, 3))
    assert line_dedup.line_dedup_digests(empty).count() == 0
    assert line_dedup.kept_text(b"a\nb\nc", line_dedup._bitmap([1])) == (b"a\nc", 3)
    assert len(zlib.decompress(line_dedup._bitmap([0, 9]))) == 2


@pytest.mark.parametrize("skip", [0, 1])
def test_runs_cut_anywhere(skip):
    cols = ["k", "o", "p", "n_owners", "first_owner"]
    schema = pa.schema([("kind", pa.int8()), *((c, pa.int64()) for c in cols)])
    for seed in range(300):
        rnd = random.Random(seed)
        rows = sorted((rnd.randint(0, 4), rnd.randint(0, 5), i) for i in range(rnd.randint(1, 25)))
        need, size, cut = rnd.choice([1, 2, 3, 4]), rnd.randint(1, 8), rnd.choice([0, 0.3, 0.8])
        cuts = [0] + [i for i in range(1, len(rows)) if rows[i][:2] != rows[i - 1][:2] and rnd.random() < cut] + [len(rows)]
        got, late, total = [], [], {}
        for a, b in zip(cuts, cuts[1:]):
            part = rows[a:b]
            batches = [pa.RecordBatch.from_arrays([pa.array([r[j] for r in part[i:i + size]], pa.int64()) for j in range(3)],
                                                  names=["k", "o", "p"]) for i in range(0, len(part), size)]
            for out in sorted_runs._stream(iter(batches), 1, need, schema, skip):
                for r in out.to_pylist():
                    if r["kind"] == 2:
                        n, f = total.get(r["k"], (0, 99))
                        total[r["k"]] = (n + r["n_owners"], min(f, r["first_owner"]))
                    else:
                        (late if r["kind"] else got).append((r["k"], r["o"], r["p"]))
        got += [r for r in late if total[r[0]][0] >= need and (not skip or total[r[0]][1] != r[1])]
        owners = {}
        for k, o, _ in rows:
            owners.setdefault(k, set()).add(o)
        assert sorted(got) == [r for r in rows if len(owners[r[0]]) >= need and (not skip or r[1] != min(owners[r[0]]))]


def brute_bytes(pairs, length):
    seen, out = set(), {}
    for d, t in sorted(set(pairs), key=lambda x: rank(x[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(w)
        out[d, t] = (d, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))),
                     sha(bytes(x for x, g in zip(b, gone) if not g)))
    return [out[p] for p in pairs]


@pytest.mark.parametrize("hot", [1024, 2])
def test_suffixes(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_STRINGS", hot)
    assert result(suffix_dedup.suffix_dedup_digests(docs)) == expect(brute_bytes(PAIRS, 100))
    if hot > 2:
        assert suffix_dedup.suffix_dedup_digests(empty).count() == 0


def test_columnwise():
    for seed in range(200):
        rnd = random.Random(seed)
        strings = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 6))]
        data, off = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *map(len, strings)])
        at, common = columnwise.suffixes(data, off, 100)
        want = sorted(s[i:] for s in strings for i in range(len(s) + 1))
        got = [b""] * len(strings) + [data[p:off[np.searchsorted(off, p, side="right")]].tobytes()
                                      for p in at[len(strings):].tolist()]
        assert got == want
        prefix = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                        for a, b in zip(want, want[1:])]
        assert common.tolist() == prefix


def shingle_set(text, size):
    w = [x.translate(FOLD) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < size else [tuple(w[i:i + size]) for i in range(len(w) - size + 1)])


def brute_near(pairs, size):
    """All pairs of texts; rows of one id are one node."""
    rows = [(d, shingle_set(t, size)) for d, t in pairs]
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, p) in enumerate(rows):
        for b, q in rows[i + 1:]:
            both = len(p & q)
            if both and 100 * both >= 80 * (len(p) + len(q) - both):
                x, y = sorted((root(a), root(b)), key=rank)
                parent[y] = x
    return [(d, len(own), root(d) if own else d, not own or root(d) == d) for d, own in rows]


@pytest.mark.parametrize("size", [2, 5])
def test_near(docs, empty, size):
    assert result(near_dup.near_dedup(docs, size)) == expect(brute_near(PAIRS, size))
    if size == 2:
        assert near_dup.near_dedup(empty).count() == 0


def test_near_ids_with_several_texts(spark):
    """Rows (3,A), (5,A), (5,B), (7,B) are one group; nulls of different texts are not."""
    prepare(spark)
    rnd = random.Random(8)
    a, b, c, d = (" ".join(f"w{rnd.randint(0, 9999)}" for _ in range(60)) for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (9, d), (8, d + " tail"), (None, a + " x"), (None, c), (11, None), (11, a), (12, "")]
    got = near_dup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in got.collect()), key=str)
    ids = {i: next(x for x in out if x[0] == i)[1] for i in (3, 5, 7, 8)}
    assert ids[3] == ids[5] == ids[7] and len([x for x in out if x[0] == 5 and x[1] == ids[3]]) == 2
    assert len(out) == len(rows) and (12, 12, True) in out
    plain = [(i, t) for i, t in rows if i is not None]
    got = near_dup.near_dedup(spark.createDataFrame(plain, "doc_id long, text string"))
    assert result(got) == expect(brute_near(plain, 2))


def test_near_against_all_pairs(spark):
    """All pairs at sf0.01, and large sets at similarities around the threshold."""
    prepare(spark)
    rnd = random.Random(12)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    for k in range(30):     # sets above SKETCHED shingles, 0.78 to 0.84 alike
        words = [f"q{k}x{i}" for i in range(1000 + 40 * k)]
        cut = round(len(words) * rnd.uniform(0.19, 0.25) / 2)
        other = words[:]
        other[:cut] = [f"p{k}x{i}" for i in range(cut)]
        rows += [(10**6 + 2 * k, " ".join(words)), (10**6 + 2 * k + 1, " ".join(other))]
    sets = [(d, shingle_set(t, 2)) for d, t in rows]
    held = {}
    for i, (_, own) in enumerate(sets):
        for x in own:
            held.setdefault(x, []).append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, own) in enumerate(sets):
        shared = Counter(j for x in own for j in held[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[j][1]) - both):
                x, y = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                parent[y] = x
    want = [(d, len(own), rows[root(i)][0], root(i) == i) for i, (d, own) in enumerate(sets)]
    got = near_dup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert result(got) == expect(want)
    assert 5 < sum(not w[3] for w in want if w[0] >= 10**6) < 30


def test_benchmark_rows_that_repeat_and_long_items(spark, monkeypatch):
    """A row repeated very often is one item; an item beyond a block is cut, its windows are not."""
    prepare(spark)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 50)
    rnd = random.Random(4)
    long_item = " ".join(f"t{rnd.randint(0, 300)}" for _ in range(3000))
    words = long_item.split()
    texts = [" ".join(words[k:k + 30]) + " end" for k in range(0, 2900, 97)] + ["nothing here", None, long_item]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(1, "one two three four five six seven eight nine ten"), (2, long_item), (3, "short item")]
    many = spark.range(100_000).select(F.lit(1).cast("long").alias("item_id"), F.lit(items[0][1]).alias("text"))
    bench = spark.createDataFrame(items, "item_id long, text string").unionByName(many)
    assert max(sum(len(t) for _, t in block) for block in decontaminate._item_blocks(bench, 10)) < 5000
    assert result(decontaminate.contamination_digests(docs, bench)) == expect(brute_leaks(list(enumerate(texts)), items))


def test_token_counts(docs, empty):
    path = vocabulary("piece_bpe_32k.model")
    scores = token_counts.load_scores(path)
    model = token_counts.Unigram(scores)

    def one(word):
        s, best = token_counts.WORD_MARK + word, [(0.0, 0)]
        for e in range(1, len(s) + 1):
            ways = [(best[b][0] + scores[s[b:e]], -(-best[b][1] + 1)) for b in range(e) if s[b:e] in scores]
            if s[e - 1] not in scores:
                ways.append((best[e - 1][0] + token_counts.UNKNOWN_SCORE, best[e - 1][1] - len(s[e - 1].encode())))
            best.append(max((w[0], best_n) for w, best_n in ((w, w[1]) for w in ways)))
        return -best[-1][1]

    want = [(d, sum(one(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t in PAIRS
            if len(t or "") < 3000]
    short = docs.where("coalesce(length(text), 0) < 3000")
    got = result(token_counts.token_counts(short, path))
    words = {w for _, t in PAIRS for w in re.findall(r"[^\x20\x09-\x0D]+", t or "") if len(w) < 40}
    assert model.sorted_counts(sorted(words)) == [one(w) for w in sorted(words)]
    assert got == expect(want)
    assert token_counts.token_counts(empty, path).count() == 0


def test_token_counts_of_long_texts(docs):
    """The texts that test_token_counts leaves out."""
    path = vocabulary("piece_bpe_32k.model")
    scores = token_counts.load_scores(path)

    def one(word):
        s, best = token_counts.WORD_MARK + word, [(0.0, 0)]
        for e in range(1, len(s) + 1):
            ways = [(best[b][0] + scores[s[b:e]], -(-best[b][1] + 1)) for b in range(e) if s[b:e] in scores]
            if s[e - 1] not in scores:
                ways.append((best[e - 1][0] + token_counts.UNKNOWN_SCORE, best[e - 1][1] - len(s[e - 1].encode())))
            best.append(max(ways))
        return -best[-1][1]

    long = [(d, t) for d, t in PAIRS if len(t or "") >= 3000]
    assert len(long) >= 2
    want = [(d, sum(one(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t))) for d, t in long]
    assert result(token_counts.token_counts(docs.where("length(text) >= 3000"), path)) == expect(want)


def items_of(pairs):
    return [(1, " ".join(pairs[9][1].split()[2:20])), (1, "word"), (2, None), (3, " .. "), (None, pairs[30][1]),
            (7, "Two-WORDS"), (7, "Two-WORDS")]


def brute_leaks(pairs, items, size=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))

    windows = {}
    for i, t in items:
        w = words(t)
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k:k + m]), set()).add("null" if i is None else str(i))
    sizes = {len(k) for k in windows}
    out = []
    for d, t in pairs:
        w, hit, found = words(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k:k + m])) in windows:
                    hit |= set(range(k, k + m))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_contamination(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = items_of(PAIRS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate.contamination_digests(docs, bench)) == expect(brute_leaks(PAIRS, items))
    if block > 300:
        none = decontaminate.contamination_digests(docs, bench.limit(0)).where("contaminated").count()
        assert none == 0 and decontaminate.contamination_digests(empty, bench).count() == 0


def test_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    path = vocabulary(VOCABULARY)
    ranks = byte_bpe.load_ranks(path)
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in PAIRS:
        ids = ref.encode_ordinary(t or "")
        want.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    assert result(byte_bpe.bpe_digests(docs, path)) == expect(want)
    assert byte_bpe.bpe_digests(empty, path).count() == 0
    codec, rnd = byte_bpe.Codec(ranks, None), random.Random(1)
    chars = "ab e\n\t \r\x0b\x1c\x85\xa0 '''sstTlLrvedm中😀٣²Ⅷ_!#\x00​ʰ"
    for _ in range(2000):
        s = "".join(rnd.choice(chars) for _ in range(rnd.randint(0, 14)))
        assert codec.encode(s) == ref.encode_ordinary(s) and codec.decode(codec.encode(s)).decode() == s
    assert set(codec.hash.slots([b"the", b"\xff\xfe\xfd"]).tolist()) >= {-1}
    back = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    assert result(back) == expect([(d, t or "") for d, t in PAIRS])


def page(pid, host, body):
    return (pid, None if host is None else f"http://{host}/en/{pid}", body)


def test_html(spark):
    prepare(spark)
    menu = "<div>Home About Contact us today please now</div>"
    rows = [page(1, "a.org", "<html><body><nav>x</nav><header>site</header><article><header><h1>T &amp; t</h1></header>"
                 "<p class='x' title=\"a>b\">One\n two<br>three<p>Four<script>if (a<b) '</p>'</script></p><aside>no</aside>"
                 "<section class='comments'><p>first!</p></section><form>f</form></article><footer>f</footer>"),
            page(2, "a.org", None), page(3, None, ""), page(4, "a.org", "plain &lt;text&gt;"),
            *(page(i, "b.org", f"<body>{menu}<div>Story number {i} is its own text</div>"
                   "<div class=sidebar>s</div><!-- c --></body>") for i in range(5, 9))]
    pages = spark.createDataFrame([(*r, "t", 1, 2) for r in rows],
                                  "page_id long, url string, html string, text string, page long, place long")
    got = {r.page_id: r.text for r in html_main.main_text(pages).collect()}
    assert got[1] == "T & t\nOne two three\nFour" and got[2] == got[3] == "" and got[4] == "plain <text>"
    assert all(got[i] == f"Story number {i} is its own text" for i in range(5, 9))
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_main.main_text(table).join(table.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(htmllib.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    assert html_main.main_text(table.limit(0)).count() == 0


def test_html_containers_are_evidence(spark):
    """Repeats decide in class-marked and main containers too; no heading, date, teaser or wrapper does."""
    prepare(spark)
    body = "The body of this page has no mark at all and is long enough to count."
    note = "<p>Follow us on every channel that we have today</p>"
    bodies = {
        1: f'<body><h1 class="post-title">Head</h1><time class="entry-date">May</time><div>{body}</div></body>',
        2: f"<main><article>Teaser one</article><article>Teaser two</article><div>{body}</div></main>",
        3: f'<body><div class="no-sidebar"><p>{body}</p><div class="sidebar">links</div></div></body>',
        4: f'<div class="sidebar-left"><main><p>{body}</p></main></div><div>Some more words outside</div>',
        5: f'<div class="sidebar-page"><p>{body}</p></div>',
        6: f'<div><article>Short</article><div>{body}</div></div>',
        **{i: f"<main><p>Story {i} is its own text {i}</p>{note}</main>"
           for i in (11, 12, 13)},
        **{i: f"<main><p>{body}</p></main><!-- {i} -->" for i in (21, 22, 23)}}
    rows = [page(i, {1: "c.org", 2: "d.org"}.get(i // 10, f"own{i}.org"), b) for i, b in bodies.items()]
    got = {r.page_id: r.text for r in html_main.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: f"Head\nMay\n{body}",
                   2: f"Teaser one\nTeaser two\n{body}", 3: body, 4: body, 5: body, 6: f"Short\n{body}",
                   **{i: f"Story {i} is its own text {i}" for i in (11, 12, 13)},
                   **dict.fromkeys((21, 22, 23), body)}


def test_html_names_and_unclosed_elements():
    """Names in any spelling, elements never closed, quotes in values, menus without names; linear time."""
    import time

    def main(body):
        return html_main.decided(html_main.blocks(body), [])[0]

    for name in ("commentlist", "commentList", "relatedPosts", "newsletterSignup", "cookiebar", "discussion",
                 "reader-feedback", "comment-list", "siteFooter", "Sidebar_left"):
        for tag in ("div", "ol"):
            assert main(f"<article><p>Story text here</p><{tag} class='{name}'>other words</{tag}></article>") == ["Story text here"], name
    assert main("<article><p>Story</p><div class='commentary shared-content'>more</div></article>") == ["Story", "more"]
    assert main("<body><nav><a>x</a><article><p>Story text</p></article></body>") == ["Story text"]
    assert main("<article>Main</article><aside><article>teaser</article></aside>") == ["Main"]
    assert main("<article><p>Story</p><div class=it's><p>more</p></div><p>tail</p></article>") == ["Story", "more", "tail"]
    assert main("<form><div>All the text of the page</div></form>") == ["All the text of the page"]
    menu = "".join(f"<div><a href=/{i}>Link {i}</a></div>" for i in range(4))
    assert main(f"<body>{menu}<div>Body text of this page</div></body>") == ["Body text of this page"]
    for page_ in ('<div class="comment">x' * 8000, "<div><p>x" * 8000 + "</p>" * 8000, "<div a= b= c= " * 8000):
        start = time.perf_counter()
        html_main.blocks(page_)
        assert time.perf_counter() - start < 1.0


def test_html_repeats_against_brute_force(spark):
    """Against a run finder in plain Python that looks up every run of RUN tokens of every page:
    only repeated blocks are dropped, every block that repeats as a whole is, and nine pages in
    ten get the same text.  Pages without article tags, repeated rows, null hosts, and a very long page."""
    prepare(spark)
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()
    note = "<p>Subscribe now and read all stories of this site without any limit</p>"
    rows = [(int(r.page_id), f"http://h{i % 9}.org/{i}" if i % 31 else None,
             re.sub("</?article>", "", r.html).replace("</h1>", "</h1>" + note if i % 2 else "</h1>"))
            for i, r in enumerate(table.itertuples())]
    rows += [rows[3], rows[3], rows[3], (None, rows[5][1], rows[5][2]), (900, rows[7][1], "<p>" + "word " * 60000 + "</p>" + note)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    every, parsed = {}, []
    for row in rows:
        found = html_main.blocks(row[2])
        host = re.match(r"http://([^/]+)", row[1])[1] if row[1] else ""
        tokens = [w for _, t in found for w in t.split()]
        ends = np.cumsum([0, *(len(t.split()) for _, t in found)])
        pieces = [(a, tuple(tokens[a:b])) for a, b in zip(ends, ends[1:])]
        pieces += [(i, tuple(tokens[i:i + html_main.RUN])) for i in range(len(tokens) - html_main.RUN + 1)]
        for k, (_, piece) in enumerate(pieces):
            every.setdefault((host, piece), set()).add(row)
            if k < len(found):
                every.setdefault((host, "block", piece), set()).add(row)
        parsed.append((row, host, found, pieces))

    got = {}
    for r in html_main.main_text(pages).collect():
        got.setdefault((r.page_id, r.url), []).append((r.text, r.decided_by))
    assert sum(map(len, got.values())) == len(rows)
    dropped = same = 0
    for (page_id, url, _), host, found, pieces in parsed:
        texts = set(got[page_id, url])
        assert len(texts) == 1
        (text, how), = texts
        blocks = [t for z, t in found if z != html_main.OUT]
        places = [(at, len(p)) for at, p in pieces if len(every[host, p]) >= html_main.PAGES]
        least = html_main.decided(found, places)[0]
        kept = text.split("\n") if text else []
        assert how == "repeated runs" and not Counter(least) - Counter(kept) and not Counter(kept) - Counter(blocks)
        whole = {" ".join(p) for at, p in pieces[:len(found)] if len(every[host, "block", p]) >= html_main.PAGES}
        assert whole.isdisjoint(kept)
        dropped += len(kept) < len(blocks)
        same += kept == least
    assert dropped > 100 and same > 0.9 * len(parsed)


def test_html_every_suffix_is_sorted(spark):
    """A run that is just long enough is found wherever it stands in a block that differs, on
    three pages and not on two; the suffix at every token is in the array."""
    prepare(spark)

    def body(host, i):
        own = [f"w{host}x{i}x{k}" for k in range(12)]
        run = [f"r{host}x{k}" for k in range(html_main.RUN)]
        at = (host + 3 * i) % 5
        return (f"<div>Page {i} of host {host} has a long enough text of its own {' '.join(own[6:])}</div>"
                f"<div>{' '.join(own[:at] + run + own[at:5])}</div>")

    table = [page(100 * h + i, f"s{h}.org", body(h, i)) for h in range(40) for i in range(3 if h % 4 else 2)]
    got = {r.page_id: r.text.split("\n") for r in html_main.main_text(
        spark.createDataFrame(table, "page_id long, url string, html string").repartition(3)).collect()}
    assert {k: len(v) for k, v in got.items()} == {100 * h + i: 1 if h % 4 else 2 for h in range(40) for i in range(3 if h % 4 else 2)}
    found = html_main.blocks(body(1, 1))
    tokens = sum(len(t.split()) for _, t in found)
    assert [*html_main.suffixes(7, found)[1][len(found):]] == [*range(tokens - html_main.RUN + 1)]


@pytest.mark.parametrize("limit", ["0", "8000000"])
def test_html_rows_of_a_page_count_once(spark, limit):
    """A page in several rows, files and tasks is one page of its host, whether the repeated
    pages are few enough to be told from the others or not."""
    prepare(spark)
    run = " ".join(f"r{k}" for k in range(html_main.RUN))

    def body(i):
        return f"<div>Page {i} has a long enough text of its own here {i}</div><div>{run} {i}</div>"

    table = [page(i, f"s{h}.org", body(i)) for h in range(6) for i in (10 * h, 10 * h, 10 * h, 10 * h + 1, *([10 * h + 2] if h % 2 else []))]
    old = spark.conf.get("tickmart.broadcast.maxBytes", None)
    spark.conf.set("tickmart.broadcast.maxBytes", limit)
    try:
        got = html_main.main_text(spark.createDataFrame(table, "page_id long, url string, html string").repartition(7)).collect()
    finally:
        spark.conf.unset("tickmart.broadcast.maxBytes") if old is None else spark.conf.set("tickmart.broadcast.maxBytes", old)
    assert len(got) == len(table)
    assert all(len(r.text.split("\n")) == (1 if r.page_id // 10 % 2 else 2) for r in got)


@pytest.mark.parametrize("kind", ["article", "section"])
def test_html_suffixes_in_few_bytes(monkeypatch, kind):
    """What tasks send of their suffixes marks, also over several chunks and ranges and where
    pages come again, just those that three pages have, in few bytes: a hash (and the place of it)
    takes well under the 9 of a hash and a page (and the 16 more of a place)."""
    rnd = random.Random(3)
    shared = [" ".join(f"s{rnd.randrange(10**6)}" for _ in range(9)) for _ in range(30)]
    pages = [(i % 3, 7919 * i + 1, i % 10 == 0, f"<{kind}><p>" + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(400))
              + f"</p><p>{shared[i % 30]}</p><p>Two words</p><p>{'same ' * (i % 13)}</p></{kind}>") for i in range(300)]
    pages += [(1, 5, False, f"<div>{shared[1]}</div><div>And a page that is open</div>"), *pages[::10]]
    hashes = {(host, key): html_main._hashes(host, html_main.blocks(raw)) for host, key, _, raw in pages}
    every = Counter(h for own in hashes.values() for h in {*own.tolist()})
    least = {key: np.packbits([every[h] >= html_main.PAGES for h in own.tolist()]).tobytes()
             for (_, key), own in hashes.items() if kind == "section" or key == 5}
    names = ("host", "page", "again", "html")
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pages[i:i + 50], strict=True)], names=names) for i in range(0, len(pages), 50)]

    def groups(table, name):
        return [(x, table.filter(pa.compute.equal(table[name], x))) for x in table[name].unique()]

    for chunk in (1 << 22, 20_000):
        monkeypatch.setattr(html_main, "CHUNK", chunk)
        for bits in (1, 3):
            rows = pa.Table.from_batches(html_main._packed_suffixes(bits)(iter(batches)))
            found = pa.concat_tables(html_main._shared_places(bits)((part,), own) for part, own in groups(rows, "part"))
            marks = [x for _, own in groups(found, "chunk") for x in html_main._page_marks(own).to_pylist()]
            assert {(x["page"], x["marks"]) for x in marks} == {x for x in least.items() if any(x[1])}
            if (chunk, bits) == (1 << 22, 1):
                counted = rows.filter(pa.compute.is_null(rows["pages"]))
                size = sum(len(x or b"") for c in ("hashes", "rest", "places") for x in counted[c].to_pylist())
                assert 90_000 < len(every) and size < (7 if kind == "article" else 11) * len(every)


def test_language(spark, docs, empty):
    prepare(spark)
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 40")
    got = langid.language_id(known, sample=200).join(known.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.language == r.lang for r in got) > 0.98 * len(got) and sum(r.kept for r in got) > 0.99 * len(got)
    out = {r.doc_id: r.kept for r in langid.language_id(docs).collect()}
    assert not out[0] and not out[1] and not out[2] and langid.language_id(docs).count() == len(ROWS)
    assert langid.keep_known(docs).columns == docs.columns
    assert langid.language_id(empty).count() == 0
    pages = spark.createDataFrame([("http://a.b.fr/de/x", "<HTML lang='de'>")], "url string, html string")
    host, suffix = langid.suffix_of(pages.url)
    assert tuple(pages.select(host, suffix, langid.declared_of(pages.html)).first()) == ("a.b.fr", "fr/de", "de")


def test_rare_language(spark):
    """A language far below the sample's share has a table, whatever its share and script."""
    prepare(spark)
    rnd = random.Random(3)

    def text(words, n=40):
        return " ".join(rnd.choice(words) for _ in range(n))

    english = "the of and that with from this have which their would about other there".split()
    rare = {"el": "και των που για την από στην είναι ότι μια".split(), "fi": "että olla joka mutta niin kuin sitä minä hän".split()}
    rows = [(i, text(english), "en", f"h{i % 7}") for i in range(3000)]
    rows += [(3000 + 10 * j + i, text(words), code, f"h{i}") for j, (code, words) in enumerate(rare.items())
             for i in range(4)] + [(None, text(rare["el"]), "el", "h1"), (4000, None, "xx", "h1"), (4001, "12 3", "yy", "h1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert langid.fit(docs, sample=200).languages == ["el", "en", "fi", "und"]
    got = {r.doc_id: (r.language, r.kept) for r in langid.language_id(docs, sample=200).collect()}
    assert all(got[d] == ((g, True) if d not in (4000, 4001) else ("und", False)) for d, _, g, _ in rows)


def brute_languages(rows, model):
    """id -> (language, confidence) of rows (id, text, declared, suffix, site)."""
    n, strength, score, sums = len(model.languages), langid.STRENGTH, [], {}
    for _, text, *_ in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        bins, valid = langid.trigrams(data, np.array([0, len(data)]))
        score.append([langid.TEMPER * float(x[bins[valid]].sum(dtype=np.float64)) for x in model.table])
    text_only = []
    for x, (_, _, said, end, site) in zip(score, rows):
        e = [np.exp(v - max(x)) for v in x]
        text_only.append([v / sum(e) for v in e])
        for k in ((), ("d", said), ("x", end), ("h", end, site)):
            old = sums.get(k, (0, [0.0] * n))
            sums[k] = (old[0] + 1, [a + b for a, b in zip(old[1], text_only[-1])])
    total, mass = sums[()]
    out = {}
    for x, own, (i, _, said, end, site) in zip(score, text_only, rows):
        (dn, d), (xn, e), (hn, h) = sums["d", said], sums["x", end], sums["h", end, site]
        post = []
        for j in range(n):
            rest = mass[j] - own[j] + strength
            region = (e[j] - own[j] + strength * (mass[j] + 1) / (total + n)) / (xn - 1 + strength)
            post.append(x[j] + np.log((d[j] - own[j] + strength * dn / total) / rest)
                        + np.log((e[j] - own[j] + strength * xn / total) / rest)
                        + np.log((h[j] - own[j] + strength * region) / (hn - 1 + strength)))
        top = max(post)
        out[i] = (model.languages[post.index(top)], 1 / sum(np.exp(v - top) for v in post))
    return out


def test_language_of_pages(spark):
    """Markup and address evidence against a posterior in plain Python."""
    prepare(spark)
    from urllib.parse import urlsplit

    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = []
    for i, r in enumerate(table.select("url", "html").collect()):
        text = " ".join(re.sub(r"(?s)<(script|style).*?</\1>|<[^>]*>", " ", r.html).split())
        at = urlsplit(r.url)
        code = at.path.split("/")[1] if at.path else ""
        code = code.lower() if re.fullmatch("[A-Za-z]{2}", code) else ""
        said = re.search(r'<html lang="(\w+)"', r.html)[1]
        rows.append((i, text[:12], said, f"{at.hostname.split('.')[-1]}/{code}", at.hostname, r.url, r.html))
    docs = spark.createDataFrame([(r[0], r[1], *r[5:]) for r in rows], "doc_id long, text string, url string, html string")
    docs = docs.withColumn("said", langid.declared_of(docs.html))
    got = {r.doc_id: r for r in langid.language_id(docs, declared="said", url="url").collect()}
    want = brute_languages([r[:5] for r in rows], langid.fit(docs, "said"))
    for i, (language, confidence) in want.items():
        assert got[i].confidence == pytest.approx(confidence, rel=1e-5)
        assert got[i].language == (language if re.search(r"[^\W\d_]", rows[i][1]) else "und")
    assert len({r[3] for r in rows}) > 2 and len({r[2] for r in rows}) > 2


def test_language_stage(docs):
    """The rows that the pipeline's language stage keeps, against the posterior in plain Python."""
    rows = [(i, r[1] or "", r[2] or "", "", r[3] or "") for i, r in enumerate(ROWS)]
    want = []
    for i, (language, sure) in brute_languages(rows, langid.fit(docs)).items():
        if re.search(r"[^\W\d_]", rows[i][1]) and language != langid.UNKNOWN and sure >= 0.5:
            want.append((ROWS[i][0], ROWS[i][1]))
    assert 0 < len(want) < len(ROWS)
    assert result(langid.keep_known(docs).select("doc_id", "text")) == expect(want)


def test_many_languages(spark):
    """Many codes in several scans of a few tables each, against the plain posterior over
    all languages at once; a row repeated, one without id and one without text."""
    prepare(spark)
    rnd = random.Random(11)
    rows = []
    for c in range(80):
        words = ["".join(rnd.choice("abcdefghijklmnoprstuvz") for _ in range(rnd.randint(3, 9))) for _ in range(8)]
        for k in range(2):
            text = " ".join(rnd.choice(words) for _ in range(rnd.choice((1, 2, 40))))
            rows.append((2 * c + k, text, f"q{c:03d}", "", f"h{c % 5}"))
    rows += [rows[5], rows[5], (None, rows[7][1], "q003", "", "h1"), (None, "", "", "", "h1")]
    table = [(d, t or None, g or None, h) for d, t, g, _, h in rows]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
    want = brute_languages([(i, *r[1:]) for i, r in enumerate(rows)], langid.fit(docs))
    found = langid.language_id(docs, held=16, tables=2).collect()
    got = {(r.doc_id, r.text_key): r for r in found}
    keys = [(r.doc_id, r.k) for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()]
    assert len(found) == len(rows) and set(keys) == set(got)
    for key, row, (language, confidence) in zip(keys, rows, want.values()):
        assert got[key].language == (language if row[1] else "und")
        assert got[key].confidence == pytest.approx(confidence, rel=1e-6)


def test_quality(spark, docs, empty):
    prepare(spark)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").dropDuplicates(["doc_id"])
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = quality.quality(table, fit).join(held.withColumnRenamed("quality", "label"), "doc_id").collect()
    assert sum(r.kept == bool(r.label) for r in got) > 0.95 * len(got)
    none = labels.limit(0)
    assert quality.quality(docs, none).count() == len(ROWS) and quality.quality(empty, labels).count() == 0
    few = spark.createDataFrame([(1, "a", "x", 0.9), (2, "a", "x", 0.9), (3, "a", "y", 0.1)],
                                "doc_id long, host string, path string, p double")
    out = {r.doc_id: r for r in quality.combined(few, strength=2.0).collect()}
    mean = 1.9 / 3
    assert out[1].host_posterior == pytest.approx((1.0 + 2 * mean) / 4)
    assert out[1].path_posterior == pytest.approx((0.9 + 5 * out[1].host_posterior) / 6)


def plain_features(text):
    data = (text or "").encode()
    words = [w.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for w in re.findall(rb"[^\x20\x09-\x0D]+", data)]
    n, size, signs = max(len(words), 1), max(len(data), 1), b"#$%&*+/<=>@[\\]^_`{|}~"

    def share(chars):
        return sum(b in chars for b in data) / size

    upper, lower = bytes(range(65, 91)), bytes(range(97, 123))
    return [np.log1p(len(words)), sum(map(len, words)) / n, share(upper) / max(share(upper + lower), 1e-3), share(signs),
            share(b"!"), share(b"0123456789"), sum(a == b for a, b in zip(words, words[1:])) / n,
            np.log1p(len(set(words)) / n ** 0.5), share(b"\n"), sum(w[-1] in signs + b"!" for w in words) / n,
            sum(len(w) > 25 for w in words) / n]


def test_quality_of_all_rows(spark, docs):
    """Features, fit and hierarchy of every row against plain Python: nulls, empty and very
    long texts, repeated rows, repeated labels, null hosts and paths."""
    prepare(spark)
    ids = sorted({r[0] for r in ROWS if r[0] is not None})
    labels = [(i, i * 7 % 5 % 2) for i in ids if i % 4] + [(ids[1], 0), (None, 1), (4, None)]
    best = {}
    for i, y in labels:
        if i is not None and y is not None:
            best[i] = max(best.get(i, 0), y)
    x = [plain_features(r[1]) for r in ROWS]
    known = [(f, best[r[0]]) for f, r in zip(x, ROWS) if r[0] in best]
    fx, y = np.array([f for f, _ in known]), np.array([v for _, v in known], float)
    centre, scale = fx.mean(0), fx.std(0) + 1e-9
    z = (fx - centre) / scale
    # The fit is where the gradient of the penalised likelihood is zero.
    w, b = quality.fit_logistic(fx, y)
    p = 1 / (1 + np.exp(-(fx @ w + b)))
    assert np.abs(z.T @ (p - y) + w * scale).max() < 1e-6 and abs((p - y).sum()) < 1e-4
    p = [float(1 / (1 + np.exp(-(np.array(f) @ w + b)))) for f in x]
    groups = {}
    for v, r in zip(p, ROWS):
        for k in ((), (r[3],), (r[3], r[2])):
            groups.setdefault(k, []).append(v)
    mean = sum(groups[()]) / len(ROWS)
    hosts = [v for k, v in groups.items() if len(k) == 1 and len(v) >= 5]
    spread = np.var([sum(v) / len(v) for v in hosts], ddof=1) - np.mean([mean * (1 - mean) / len(v) for v in hosts])
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0

    def odds(v):
        v = min(max(v, 1e-6), 1 - 1e-6)
        return np.log(v / (1 - v))

    want = []
    for v, r in zip(p, ROWS):
        host, path = groups[r[3],], groups[r[3], r[2]]
        at_host = (sum(host) - v + strength * mean) / (len(host) - 1 + strength)
        at_path = (sum(path) - v + quality.PATH_STRENGTH * at_host) / (len(path) - 1 + quality.PATH_STRENGTH)
        want.append((r[0], v, at_host, at_path, 1 / (1 + np.exp(-(odds(v) + odds(at_path) - odds(mean))))))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = [(r.doc_id, r.p_text, r.host_posterior, r.path_posterior, r.quality) for r in quality.quality(docs, marks).collect()]
    assert len(got) == len(want)

    def ordered(found):
        return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, round(r[1], 6)))

    for a, e in zip(ordered(got), ordered(want)):
        assert a[0] == e[0] and a[1:] == pytest.approx(e[1:], rel=1e-5, abs=1e-7)


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline as cp

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = items_of(PAIRS)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = result(cp.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "decoded_sha256"))
    alive = {r.doc_id for r in langid.language_id(docs).where("kept").collect()}
    left = {}
    for d, t in PAIRS:
        if d in alive and (t not in left or rank(d) > rank(left[t])):
            left[t] = d
    near = {d for d, _, _, kept in brute_near([(d, t) for t, d in left.items()], 5) if kept}
    clean = {r[0] for r in brute_leaks(PAIRS, items) if not r[5]}
    want = sorted((sha(t.encode()) for t, d in left.items() if d in near and d in clean))
    assert sorted(r[2] for r in got) == want
