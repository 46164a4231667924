"""Main text of web pages (operator 2): page structure, and a host suffix array
for what structure leaves open.

A page is read as blocks of text in zones: inside a container of the article (of
three strengths), what markup names as something else (menus, footers, adverts,
forms, comments, ...), and the rest.  The token streams of a host's pages are
concatenated and their suffixes sorted by host and content: a substring that ``PAGES``
distinct pages of the host share is boilerplate, and a block that such substrings
cover for the most part goes.  A container is evidence: it decides if it holds at
least as many tokens as the blocks outside it that are left; else the next weaker one,
else all blocks left.  Two things outweigh repeats: an ``article`` element that decides
keeps all its blocks, and a weaker container that repeats as a whole is kept (a page
under several addresses is no boilerplate).

The suffix array is whole: the suffix at every token of every page is sorted, to a depth
of ``RUN`` tokens, and each block of fewer tokens (a longer one is covered by its runs).
What ``PAGES`` pages share from some token on for ``RUN`` tokens or more is found at that
token; each further ``RUN`` tokens of a longer shared substring are the head of a later
suffix that the same pages share, so a deeper order would cover no other token.  Sorting
and counting go by ranges of the hash of host and run, a task a range; nothing goes
through the driver.  A task before sends each of its hashes once, as the step from the one
before it (about 5.6 bytes), with the number of its pages up to ``PAGES``: a page that
stands in one row only is in one task only, so the numbers add up.  Pages that may stand
in several rows go by name, at most ``PAGES`` of one hash from a task.  Pages that their
``article`` element settles whatever repeats (it holds at least half of the text) are
evidence for the others, and are cut without being looked up.  The others are looked up
where they are counted: a hash has its places in the chunk of its task beside it (3 bytes),
unless that chunk alone has ``PAGES`` pages of it, so a task has at most ``PAGES - 1`` pages'
places of a hash from a chunk; what comes back is a bit for each suffix of a page.

Class words that exclude are no proof either: negated ones (``no-sidebar``), those
around the page's main element or its only article, and those around nearly all of its
text are ignored; so are ``nav``, ``form`` and the like around nearly all of it (an
element never closed).  Three or more blocks in a row, outside the article, that are
links for the most part are a menu, whatever their names.

Defined results: null and empty pages have an empty text; a null url is a host
of its own; pages alike in every column count as one page of the host; repeated
rows give repeated results; ties in size go to the stronger container; a page is
parsed in time linear in its length, however deep it is nested; an empty table gives no
rows.  Other columns are never looked at.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.textscan import U64, Words, mix, space_word_table
from tickmart.operators.joins import broadcast_bytes, broadcast_limit
from tickmart.sinks.tables import stage

RUN = 6         # tokens of a suffix
PAGES = 3       # distinct pages of a host that hold it
COVERED = 0.5   # share of a block's tokens in such runs, above which it goes
WRAPS = 0.9     # share of a page's text, from which an element is its wrapper, whatever its class

LINKS, LINKED_BLOCKS = 0.8, 3   # share of a block's letters in links, blocks in a row, of a menu
CHUNK = 1 << 23                 # suffixes that a task sorts at a time
PARTS = 8                       # ranges of hashes for each shuffle partition, at least
PART_CHARS = 1 << 25            # characters of pages for each range, at most
TOKENS = Words(space_word_table(), seed=11, fold=False)

# Element names and marker words of page structure.
DROPPED_WHOLE = "script style title textarea iframe noscript template svg noframes xmp math object select button".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
EXCLUDED = frozenset("dialog head".split())
DOUBTED = frozenset("nav footer aside form menu fieldset".split())      # excluded, unless around nearly all
EXCLUDED_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
search toolbar""".split())
EXCLUDED_WORDS = """ad adbox advert advertisement advertising banner breadcrumb byline cookie comment consent
copyright discussion disqus feedback footer gdpr login masthead menu modal nav navbar navigation newsletter notice
overlay pager pagination pingback popup promo promoted promotion recommended related reply replies respond search
share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar trackback widget""".split()
# Words that stand before or behind one of them in names written together.
NAME_PARTS = """area article bar block blog bottom box btn button container content count feed fixed footer form global group
holder icon inline inner item left link list main mini module nav outer page panel pane post reader right row section
signup site slot sticky text thread top unit user widget wrap wrapper zone""".split()
ARTICLE_WORDS = frozenset("article articlebody content entry post story".split())
ARTICLE_TAGS = frozenset("blockquote center dd div dl li ol section table tbody td tr ul".split())  # where they count
NEGATIONS = frozenset("has have hide no non not with without".split())
PARAGRAPH_ENDS = BLOCK - {"body", "html", "head", "caption", "legend"}
SAME_ENDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}

_NAME = re.compile(rf"(?:{'|'.join(NAME_PARTS)})?(?:{'|'.join(EXCLUDED_WORDS)})s?(?:(?:{'|'.join(NAME_PARTS)})s?)?")
# A quote inside an unquoted value is a letter like any other; no part of it is tried twice.
_ATTRS = r"""(?>[^<>"'=]+|=\s*+(?:"[^"]*"|'[^']*'|[^\s<>"'][^\s<>]*+)?|["'])*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(DROPPED_WHOLE)})\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-z][\w:-]*)(?P<attrs>{_ATTRS})>|<[!?/a-z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.I | re.S)
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

OUT, OPEN, WEAK, MAIN, ARTICLE = -1, 0, 1, 2, 3     # zones; the last three are containers of the article


def _words(name: str) -> list[str]:
    """Parts of a class or id: at case changes and whatever is no letter."""
    return re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())


def _zone(tag: str, attrs: str, around: int) -> tuple[int, bool]:
    """(zone of an element inside one of zone ``around``, whether its name, class or id excludes it)."""
    if around == OUT:
        return OUT, False
    zone, doubted = around, tag in DOUBTED or tag == "header" and around < WEAK
    if tag == "article":
        zone = ARTICLE
    elif tag == "main":
        zone = max(zone, MAIN)
    elif tag in EXCLUDED:
        return OUT, False
    if attrs and tag not in ("html", "body"):
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
        if "hidden" in values or values.get("aria-hidden") == "true" \
                or re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
            return OUT, False
        role = values.get("role", "").lower()
        if role in EXCLUDED_ROLES:
            return OUT, False
        if role in ("main", "article"):
            zone = max(zone, MAIN if role == "main" else ARTICLE)
        for name in (values.get("class", "") + " " + values.get("id", "")).split():
            words = _words(name)
            if not NEGATIONS.isdisjoint(words):
                continue
            doubted |= tag not in ("article", "main") and any(_NAME.fullmatch(w) for w in words)
            if tag in ARTICLE_TAGS and not ARTICLE_WORDS.isdisjoint(words):
                zone = max(zone, WEAK)
    return zone, doubted


NONE = -1


class _Page:
    """What one reading of a page finds: blocks, and the doubted elements around them.

    A doubted element knows the next one around it, so sums over all that are nested go
    once through them, inside out."""

    def __init__(self):
        self.found: list[tuple[int, int, str, float]] = []     # zone, doubted element around, text, share of links
        self.around: list[int] = []                            # of each doubted element
        self.trusted: set[int] = set()                         # doubted elements around the main element
        self.articles: list[int] = []                          # doubted element around each article element

    def trust(self, doubt: int) -> None:
        """The doubted elements from ``doubt`` outwards are around the main text."""
        while doubt != NONE and doubt not in self.trusted:
            self.trusted.add(doubt)
            doubt = self.around[doubt]

    def settled(self) -> list[tuple[int, str]]:
        """(zone, text) of the blocks."""
        n = len(self.around)
        text, strong = [0] * n, [0] * n
        for zone, doubt, plain, _ in self.found:
            if doubt != NONE and zone != OUT:
                text[doubt] += len(plain)
                strong[doubt] += zone >= WEAK
        for i in range(n - 1, -1, -1):
            if self.around[i] != NONE:
                text[self.around[i]] += text[i]
                strong[self.around[i]] += strong[i]
        total = sum(len(t) for z, _, t, _ in self.found if z != OUT)
        every = sum(z >= WEAK for z, _, _, _ in self.found)
        wrapping = {i for i in range(n) if text[i] >= WRAPS * total and strong[i] == every}
        out = self._out(self.trusted | wrapping)
        if not any(z >= MAIN and (d == NONE or not out[d]) for z, d, _, _ in self.found):
            # No article is left: the elements around the articles are no reason to drop them.
            for doubt in self.articles:
                self.trust(doubt)
            out = self._out(self.trusted | wrapping)
        zones = [OUT if d != NONE and out[d] else z for z, d, _, _ in self.found]
        links = [z < MAIN and share >= LINKS for z, (_, _, _, share) in zip(zones, self.found, strict=True)]
        k = 0
        while k < len(links):
            end = k
            while end < len(links) and links[end]:
                end += 1
            if end - k >= LINKED_BLOCKS:
                zones[k:end] = [OUT] * (end - k)
            k = end + 1
        return [(z, t) for z, (_, _, t, _) in zip(zones, self.found, strict=True)]

    def _out(self, trusted: set[int]) -> list[bool]:
        out: list[bool] = []
        for i, outer in enumerate(self.around):
            out.append(i not in trusted or outer != NONE and out[outer])
        return out


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks with text, in order."""
    read = _Page()
    stack: list[tuple[str, int, int]] = [("", OPEN, NONE)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = links = 0               # letters in links since the last block, links open

    def flush():
        nonlocal linked
        if text:
            if plain := " ".join(html.unescape("".join(text)).split()):
                read.found.append((*stack[-1][1:], plain, linked / len(plain)))
            text.clear()
        linked = 0

    def pop_to(i: int):
        flush()
        opened.subtract([name for name, _, _ in stack[i:]])
        del stack[i:]

    for m in TOKEN.finditer(page):
        if (plain := m["text"]) is not None:
            text.append(plain)
            if links:
                linked += len(plain.strip())
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "a":
            links = 0 if m["close"] else 1
        if tag in VOID:
            if tag == "br":
                text.append(" ")
            elif tag == "hr":
                flush()
            continue
        if m["close"]:
            if opened[tag]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
            continue
        block = tag in BLOCK
        if block:
            flush()
            if tag in PARAGRAPH_ENDS and opened["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag and tag in SAME_ENDS:
                    pop_to(i)
                    break
                if stack[i][0] in SAME_ENDS.get(tag, BLOCK):
                    break
                if tag in SAME_ENDS and not opened[tag]:
                    break
        _, around, doubt = stack[-1]
        zone, doubted = _zone(tag, m["attrs"], around)
        if zone == MAIN > around and (tag == "main" or "role" in m["attrs"].lower()):
            read.trust(doubt)
        if zone == ARTICLE > around:
            read.articles.append(doubt)
        if doubted:
            read.around.append(doubt)
            doubt = len(read.around) - 1
        if not block and zone == around and not doubted:
            continue
        if not block:                       # an inline element with a zone of its own
            flush()
        stack.append((tag, zone, doubt))
        opened[tag] += 1
    flush()
    return read.settled()


def _tokens(found: list[tuple[int, str]]) -> np.ndarray:
    """Hash of every token of the blocks, in order."""
    data = np.frombuffer("\n".join(t for _, t in found).encode(), np.uint8)
    return TOKENS.find(data, np.array([0, len(data)]))[2]


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*:?//([^/?#]*)", 1))


def _page_key() -> Column:
    return F.xxhash64("page_id", "url", "html")


def _sizes(found: list[tuple[int, str]]) -> list[int]:
    return [t.count(" ") + 1 for _, t in found]


def suffixes(host: int, found: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of host and content, first token, tokens) of a page's whole blocks and of the
    suffix at each of its tokens that RUN tokens are left from."""
    sizes = _sizes(found)
    key = np.array([host], np.int64).view(U64)
    ends = np.cumsum([0, *sizes])
    whole = mix(np.array([xxhash.xxh3_64_intdigest(t) for _, t in found], U64) ^ mix(key)) if found else np.zeros(0, U64)
    t = _tokens(found) if found else np.zeros(0, U64)
    n = len(t) - RUN + 1
    if n <= 0:
        return whole, ends[:-1], np.array(sizes, np.int64)
    run = np.full(n, key[0])
    for j in range(RUN):
        run = mix(run ^ t[j:j + n])
    return (np.concatenate((whole, run)), np.concatenate((ends[:-1], np.arange(n))),
            np.concatenate((np.array(sizes, np.int64), np.full(n, RUN))))


def is_settled(found: list[tuple[int, str]]) -> bool:
    """Whether the ``article`` element decides, whatever repeats (or there is nothing to decide)."""
    inside = sum(n for n, (z, _) in zip(_sizes(found), found, strict=True) if z >= ARTICLE)
    return inside > 0 and inside >= sum(n for n, (z, _) in zip(_sizes(found), found, strict=True) if OUT < z < ARTICLE) or not found


PACKED = "part int, chunk long, hashes binary, rest binary, places binary, pages binary, sizes binary, marks binary"
KINDS = {"part": pa.int32(), "chunk": pa.int64()}
FOUND = "chunk long, places binary, pages binary, sizes binary, marks binary"
LOW = 4         # bytes of a step that are random


def _looked_up(found: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which of the whole blocks, first token, tokens) of the suffixes that are looked up: a
    block of RUN tokens or more is covered by its runs."""
    sizes = np.array(_sizes(found), np.int64)
    short = sizes < RUN
    n = max(int(sizes.sum()) - RUN + 1, 0)
    return (short, np.concatenate((np.cumsum([0, *sizes])[:-1][short], np.arange(n))),
            np.concatenate((sizes[short], np.full(n, RUN))))


def _hashes(host: int, found: list[tuple[int, str]]) -> np.ndarray:
    """Hashes of the suffixes that are looked up, in order."""
    h = suffixes(host, found)[0]
    return np.concatenate((h[:len(found)][_looked_up(found)[0]], h[len(found):]))


def _binary(values: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in values.view(np.uint8).reshape(len(values), -1).T]


def pack_steps(h: np.ndarray, first: np.uint64, counts: np.ndarray, more: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """Sorted hashes from ``first`` on as steps, byte by byte of all of them: the random bytes,
    and, each with a code of its own, the others, ``counts`` and ``more``."""
    steps = _binary(np.diff(h, prepend=first))
    code = zlib.compressobj(1, zlib.DEFLATED, -15, 8, zlib.Z_RLE)
    rest = [x for plane in (*steps[LOW:], counts.astype(np.uint8).tobytes(), *(() if more is None else _binary(more.astype(np.uint32))))
            for x in (code.compress(plane), code.flush(zlib.Z_PARTIAL_FLUSH))]
    return b"".join(steps[:LOW]), b"".join((*rest, code.flush()))


def unpack_steps(low: bytes, rest: bytes, first: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    planes = np.frombuffer(low + zlib.decompress(rest, -15), np.uint8).reshape(-1, len(low) // LOW)
    steps, more = (np.ascontiguousarray(x.T) for x in (planes[:8], planes[9:]))
    return (np.cumsum(steps.view(U64)[:, 0], dtype=U64) + first, planes[8].astype(np.int64),
            more.view(np.uint32)[:, 0] if len(planes) > 9 else None)


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``h`` stand in the sorted ``known``."""
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)


def _summed(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of ``h`` once, sorted, and the sum of its counts."""
    if not len(h):
        return h, counts
    order = np.argsort(h)
    h, counts = h[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[at], np.add.reduceat(counts, at)


def _packed_suffixes(bits: int):
    """Rows of sorted suffixes by range of their hash.  A page that no other row repeats is one
    more in the counts of its hashes; pages that may be repeated are named (at most PAGES of
    one hash in a chunk).  Beside the hash stand the places in the chunk where pages that
    aren't settled have it, unless PAGES pages of the chunk do: those are in the row of the
    chunk already."""
    shift = U64(64 - bits)
    edges = np.arange(1 << bits, dtype=U64) << shift

    def batch_of(**cols) -> pa.RecordBatch:
        n = len(cols["part"])
        names = [x.split()[0] for x in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(cols.get(k, [None] * n), KINDS.get(k, pa.binary())) for k in names], names=names)

    def cut(h) -> list[int]:
        return [*np.searchsorted(h, edges).tolist(), len(h)]

    def counted(h, counts, looked, places, chunk) -> pa.RecordBatch:
        every = np.union1d(h, looked) if len(looked) else h
        pages = np.zeros(len(every), np.int64)
        pages[np.searchsorted(every, h)] = np.minimum(counts, PAGES)
        n = np.searchsorted(looked, every, "right") - np.searchsorted(looked, every) if len(looked) else None
        at, of = cut(every), cut(looked)
        parts = [p for p in range(1 << bits) if at[p + 1] > at[p]]
        cols = {"hashes": [], "rest": [], "places": []}
        for p in parts:
            own = slice(at[p], at[p + 1])
            here = of[p + 1] > of[p]
            low, rest = pack_steps(every[own], edges[p], pages[own], n[own] if here else None)
            cols["hashes"].append(low)
            cols["rest"].append(rest)
            cols["places"].append(b"".join(_binary(places[of[p]:of[p + 1]])) if here else None)
        return batch_of(part=parts, chunk=[chunk] * len(parts), **cols)

    def named(repeated) -> pa.RecordBatch:
        # A page stands here once, each of its hashes once.
        h = np.concatenate([*repeated.values()])
        pages = np.repeat(np.array([p & 0xFFFFFFFF for p in repeated], np.uint32), [len(x) for x in repeated.values()])
        order = np.argsort(h)
        h, pages = h[order], pages[order]
        enough = np.zeros(len(h), bool)
        enough[PAGES:] = h[PAGES:] == h[:-PAGES]
        h, pages = h[~enough], pages[~enough]
        at, ones = cut(h), np.ones(len(h), np.int64)
        parts = [p for p in range(1 << bits) if at[p + 1] > at[p]]
        low, rest = zip(*(pack_steps(h[at[p]:at[p + 1]], edges[p], ones[at[p]:at[p + 1]]) for p in parts), strict=True)
        return batch_of(part=parts, hashes=low, rest=rest, pages=[pages[at[p]:at[p + 1]].tobytes() for p in parts])

    def packed(single, repeated, opened):
        # Each page has each of its hashes once.
        none = [np.zeros(0, U64)]
        h = np.sort(np.concatenate(single or none))
        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        h, counts = h[at], np.diff(at, append=len(h))
        looked, places, chunk = none[0], None, None
        if opened:
            own = np.concatenate([*repeated.values()] or none)
            every, pages = _summed(np.concatenate((h, own)), np.concatenate((counts, np.ones(len(own), np.int64))))
            looked = np.concatenate([x for _, x in opened])
            places = np.argsort(looked).astype(np.uint32)
            looked = looked[places]
            here = _among(looked, every[pages >= PAGES])
            marks = np.zeros(len(looked), bool)
            marks[places[here]] = True
            looked, places = looked[~here], places[~here]
            keys = np.array([p for p, _ in opened], np.int64).tobytes()
            chunk = int(np.array([xxhash.xxh3_64_intdigest(keys)], U64).view(np.int64)[0])
            yield batch_of(part=[-1 - chunk % (1 << bits)], chunk=[chunk], pages=[keys], marks=[np.packbits(marks).tobytes()],
                           sizes=[np.array([len(x) for _, x in opened], np.int32).tobytes()])
        if len(h) or len(looked):
            yield counted(h, counts, looked, places, chunk)
        if repeated:
            yield named(repeated)

    def run(batches):
        single, repeated, opened, held = [], {}, [], 0
        for batch in batches:
            for host, page, again, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = blocks(raw) if raw else []
                if not found or again and page in repeated:
                    continue
                h = _hashes(host, found)
                own = np.unique(h)
                if again:
                    repeated[page] = own
                else:
                    single.append(own)
                held += len(own)
                if not is_settled(found):
                    opened.append((page, h))
                    held += len(h)
                if held >= CHUNK:
                    yield from packed(single, repeated, opened)
                    single, repeated, opened, held = [], {}, [], 0
        yield from packed(single, repeated, opened)
    return run


def _shared_places(bits: int):
    """Of a range of hashes the places, by chunk, of those that PAGES pages hold; or the rows of chunks."""
    def run(key, rows):
        part = key[0].as_py()
        if part < 0:
            return rows.select([x.split()[0] for x in FOUND.split(", ")])
        first = U64(part) << U64(64 - bits)
        every, held, repeated, owners, asked = [], [], [], [], []
        for chunk, low, rest, places, pages in zip(*(rows.column(c).to_pylist() for c in ("chunk", "hashes", "rest", "places", "pages")), strict=True):
            h, counts, n = unpack_steps(low, rest, first)
            if pages is not None:
                repeated.append(h)
                owners.append(np.frombuffer(pages, np.uint32))
                continue
            every.append(h)
            held.append(counts)
            if n is not None:
                asked.append((chunk, h, n, np.ascontiguousarray(np.frombuffer(places, np.uint8).reshape(4, -1).T).view(np.uint32)[:, 0]))
        if repeated:                        # each of these pages counts once for each hash
            h, pages = np.concatenate(repeated), np.concatenate(owners)
            order = np.lexsort((pages, h))
            h, pages = h[order], pages[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (pages[1:] != pages[:-1])
            every.append(h[new])
            held.append(np.ones(len(every[-1]), np.int64))
        h, pages = _summed(np.concatenate(every), np.concatenate(held))
        shared = h[pages >= PAGES]
        found = [(chunk, places[np.repeat(_among(h, shared), n)].tobytes()) for chunk, h, n, places in asked]
        found = [x for x in found if x[1]]
        none = pa.nulls(len(found), pa.binary())
        return pa.table({"chunk": pa.array([c for c, _ in found], pa.int64()), "places": pa.array([x for _, x in found], pa.binary()),
                         "pages": none, "sizes": none, "marks": none})
    return run


def _page_marks(rows: pa.Table) -> pa.Table:
    """page, marks (a bit for each suffix that is looked up) of the pages of a chunk."""
    pages, sizes, marks = (next(x for x in rows.column(c).to_pylist() if x is not None) for c in ("pages", "sizes", "marks"))
    pages, ends = np.frombuffer(pages, np.int64), np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64)
    bits = np.unpackbits(np.frombuffer(marks, np.uint8), count=int(ends[-1]))
    for places in rows.column("places").to_pylist():
        if places is not None:
            bits[np.frombuffer(places, np.uint32)] = 1
    own = [(p, np.packbits(x).tobytes()) for p, x in zip(pages.tolist(), np.split(bits, ends[:-1]), strict=True) if x.any()]
    return pa.table({"page": pa.array([p for p, _ in own], pa.int64()), "marks": pa.array([x for _, x in own], pa.binary())})


def repeated_places(pages: DataFrame) -> DataFrame:
    """page (key), marks: substrings, of pages that aren't settled, that PAGES pages of the host
    hold.  Rows alike in every column are one page; only pages that may stand in several rows
    are told apart, by 32 bits of their key."""
    seen = stage(pages.groupBy(_page_key().alias("page")).agg(
        F.count("*").alias("n"), F.sum(F.length("html")).alias("chars")), "page-keys")
    twice = seen.where("n > 1").select("page", F.lit(True).alias("again"))
    chars = seen.agg(F.sum("chars")).first()[0] or 0
    partitions = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (max(partitions * PARTS, chars // PART_CHARS) - 1).bit_length())
    rows = pages.select(F.xxhash64(_host(F.col("url"))).alias("host"), _page_key().alias("page"), "html")
    # Where too many rows are repeated for a broadcast every page is named.
    rows = (rows.join(F.broadcast(twice), "page", "left") if broadcast_bytes(twice) <= broadcast_limit(twice)
            else rows.withColumn("again", F.lit(True)))
    found = stage(rows.select("host", "page", "again", "html").mapInArrow(_packed_suffixes(bits), PACKED)
                  .groupBy("part").applyInArrow(_shared_places(bits), FOUND), "suffixes")
    # A page in several chunks has the same marks in each.
    return found.groupBy("chunk").applyInArrow(_page_marks, "page long, marks binary").groupBy("page").agg(F.max("marks").alias("marks"))


def marked(found: list[tuple[int, str]], marks: bytes | None) -> list[tuple[int, int]]:
    """(first token, tokens) of the marked substrings of a page."""
    if not marks:
        return []
    _, starts, sizes = _looked_up(found)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8), count=len(starts)))
    return [*zip(starts[at].tolist(), sizes[at].tolist(), strict=True)]


def decided(found: list[tuple[int, str]], places: list[tuple[int, int]]) -> tuple[list[str], str]:
    """(blocks that make up the main text, what decided them); ``places`` are (first
    token, tokens) of repeated substrings."""
    sizes = _sizes(found)
    covered = np.zeros(sum(sizes), bool)
    for start, size in places:
        covered[start:start + size] = True
    ends = np.cumsum([0, *sizes])
    left = [z != OUT and covered[a:b].sum() <= COVERED * (b - a)
            for (z, _), a, b in zip(found, ends, ends[1:], strict=False)]
    for level in (ARTICLE, MAIN, WEAK):
        inside = sum(n for n, (z, _) in zip(sizes, found, strict=True) if z >= level)
        if inside and inside >= sum(n for n, (z, _), u in zip(sizes, found, left, strict=True) if u and z < level):
            own = [(t, u) for (z, t), u in zip(found, left, strict=True) if z >= level]
            kept = [t for t, u in own if u]
            if level == ARTICLE:
                return [t for t, _ in own], "article element"
            if not kept:
                return [t for t, _ in own], "container that repeats as a whole"
            return kept, "container" if len(kept) == len(own) else "container without repeated blocks"
    kept = [t for (_, t), u in zip(found, left, strict=True) if u]
    return kept, "repeated runs"


def _texts(batches):
    """Main text of pages with the marks of their repeated substrings."""
    for batch in batches:
        page_id, url, pages, marks = batch.columns
        done = []
        for raw, own in zip(pages.to_pylist(), marks.to_pylist(), strict=True):
            found = blocks(raw or "")
            done.append(decided(found, marked(found, own)))
        out = ["\n".join(kept) for kept, _ in done]
        yield pa.RecordBatch.from_arrays(
            [page_id, url, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()),
             pa.array([how for _, how in done], pa.string())], names=["page_id", "url", "text", "n_chars", "decided_by"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``, and decided_by: what the
    choice of blocks rests on."""
    # A page's marks are a bit for each of its suffixes; settled pages have none.
    places = stage(repeated_places(pages), "places")
    size = places.agg(F.sum(F.length("marks") + 64)).first()[0] or 0
    side = F.broadcast(places) if size <= broadcast_limit(places) else places
    kind = pages.schema["page_id"].dataType.simpleString()
    return (pages.select("page_id", "url", _page_key().alias("page"), "html").join(side, "page", "left")
            .select("page_id", "url", "html", "marks")
            .mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long, decided_by string"))
