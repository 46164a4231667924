"""Driver queries of the operators, one ``opN_<name>`` each, with DuckDB SQL
where SQL expresses the result.  Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickmart.llm.runtime import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_line_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
""")
def line_dedup_query(spark, sf_dir):
    from tickmart.llm.line_dedup import line_dedup_digests

    return line_dedup_digests(table(spark, sf_dir, "documents"))


@query("op8_byte_bpe")
def byte_bpe_query(spark, sf_dir):
    from tickmart.llm.byte_bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), None)


EXACT = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op10_exact_dedup", EXACT)
def exact_dedup_query(spark, sf_dir):
    from tickmart.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def token_counts_query(spark, sf_dir):
    from tickmart.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op7_decontaminate", r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), spots AS (
  SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM spots
), places AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m
), hits AS (
  SELECT p.doc_id, p.i, p.m, v.item FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM places) p
  JOIN windows v ON v.m = p.m AND v.phrase = p.phrase
), words AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def decontaminate_query(spark, sf_dir):
    from tickmart.llm.decontaminate import contamination_digests

    return contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_suffix_dedup", r"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), bytes AS (
  SELECT doc_id, j, substr(h, 2 * j + 1, 2) AS byte, CASE WHEN j + 100 <= n THEN md5(substr(h, 2 * j + 1, 200)) END AS key
  FROM (SELECT doc_id, h, n, unnest(range(n)) AS j FROM docs)
), starts AS (
  SELECT doc_id, j FROM (SELECT doc_id, j, row_number() OVER (PARTITION BY key ORDER BY doc_id, j) AS nth FROM bytes WHERE key IS NOT NULL)
  WHERE nth > 1
), marked AS (
  SELECT b.doc_id, b.j, byte,
         coalesce(b.j - max(s.j) OVER (PARTITION BY b.doc_id ORDER BY b.j ROWS UNBOUNDED PRECEDING) < 100, false) AS gone
  FROM bytes b LEFT JOIN starts s ON s.doc_id = b.doc_id AND s.j = b.j
), edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS opens FROM marked
), left_over AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         string_agg(byte, '' ORDER BY j) FILTER (NOT gone) AS kept
  FROM edged GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN left_over USING (doc_id)
""")
def suffix_dedup_query(spark, sf_dir):
    from tickmart.llm.suffix_dedup import suffix_dedup_digests

    return suffix_dedup_digests(table(spark, sf_dir, "documents"))


@query("op5_near_dedup", r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT x, y FROM edges UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y
), least_ids AS (
  SELECT x, min(y) AS low FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id <= coalesce(low, doc_id) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_ids ON x = doc_id
""")
def near_dedup_query(spark, sf_dir):
    from tickmart.llm.near_dup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"))


@query("op1_quality")
def quality_query(spark, sf_dir):
    """``documents`` has no address: its source is the host, its lang the path level."""
    from tickmart.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_html_main_text")
def main_text_query(spark, sf_dir):
    from tickmart.llm.html_main import main_text

    return main_text(table(spark, sf_dir, "pages"))


@query("op9_language_id")
def language_id_query(spark, sf_dir):
    from tickmart.llm.langid import language_id

    return language_id(table(spark, sf_dir, "documents")).drop("text_key")


@query("op11_toxicity")
def toxicity_query(spark, sf_dir):
    from tickmart.llm.toxicity import labelled_toxicity

    return labelled_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_whitening")
def whitening_query(spark, sf_dir):
    from tickmart.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


@query("op13_filter_audit", r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS mask
  FROM texts LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM masks GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS fs, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT array_to_string(fs, '') AS filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), audit AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN (mask & (before + bit)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN (mask & before) = 0 AND (mask & bit) <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN (mask & before) <> 0 AND (mask & bit) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (mask & before) = 0 AND (mask & bit) <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (mask & before) = 0 AND (mask & bit) <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM audit
""")
def filter_audit_query(spark, sf_dir):
    from tickmart.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
