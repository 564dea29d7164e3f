"""One query per operator over its whole table, with the operator's production settings, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casefeatures.llm import conversations, decontaminate, jaccard, language, license, manifest, mixing, mtree, parsing, suffixes, tokens, toxicity, warc
from casefeatures.sources.files import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A text with A-Z in lower case.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


ORACLES["op3_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS x FROM d),
u AS (SELECT doc_id, len(x) AS n, unnest(x) AS t FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.t = b.t AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT s.doc_id, CAST(any_value(len(x)) AS BIGINT) AS n_shingles, min(c) AS component_id FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id
"""


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(table(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


@query
def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "archives")).drop("url")


ORACLES["op4_warc_bundles"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op5_decontamination"] = rf"""
WITH t AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1),
      lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS s FROM t WHERE len(w) > 0),
d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, (SELECT DISTINCT k FROM g)),
h AS (SELECT e.doc_id, e.i, e.k, g.item_id FROM (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM e) e JOIN g ON g.k = e.k AND g.s = e.s),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return tokens.token_counts(table(spark, sf_dir, "documents"), f.read())


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


ORACLES["op8_exact_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


ORACLES["op10_suffix_dedup"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(w) - 49)) AS i, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS h FROM d WHERE len(w) >= 50),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) = 1 AS original FROM p),
r AS (SELECT doc_id, i, original, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id, original ORDER BY i) + 50 THEN 0 ELSE 1 END AS apart FROM f WHERE n > 1),
g AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, original ORDER BY i) AS run FROM r)
SELECT doc_id, CAST(min(i) AS INTEGER) AS first_word, CAST(max(i) - min(i) + 50 AS INTEGER) AS n_words, original FROM g GROUP BY doc_id, original, run
"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@query
def op12_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.edit_likeness(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.documents_proved(table(spark, sf_dir, "documents"))


def _field(x: str) -> str:
    return f"coalesce(octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR), '-')"


#: crc32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))))"""
_HEAD = " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars"))

ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, sha256({_HEAD} || {_field("text")}) AS h, CASE WHEN {_CRC32} % 3 = 0
      THEN sha256({_HEAD} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) ELSE sha256({_HEAD} || {_field("text")}) END AS now FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM d),
t AS (SELECT lang, 0 AS lv, i, h, count(*) OVER (PARTITION BY lang) AS n FROM o
      UNION ALL SELECT lang, any_value(lv) + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM t WHERE n > 1 GROUP BY lang, i // 8),
s AS (SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i FROM t WHERE n = 1),
c AS (SELECT 0 AS lv, i, h, count(*) OVER () AS n FROM s
      UNION ALL SELECT any_value(lv) + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM c WHERE n > 1 GROUP BY i // 8),
steps AS (SELECT o.lang, o.i AS leaf, t.lv, t.i, t.h, (o.i >> (3 * t.lv)) AS own FROM o JOIN t ON t.lang IS NOT DISTINCT FROM o.lang AND t.n > 1 AND t.i // 8 = (o.i >> (3 * t.lv)) // 8
      UNION ALL SELECT o.lang, o.i, 100 + c.lv, c.i, c.h, (s.i >> (3 * c.lv)) FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang JOIN c ON c.n > 1 AND c.i // 8 = (s.i >> (3 * c.lv)) // 8),
w AS (SELECT lang, leaf, lv, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS l, coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS r FROM steps GROUP BY lang, leaf, lv),
p AS (SELECT lang, leaf, sha256(string_agg(l || r, '' ORDER BY lv)) AS proof, list({{'l': l, 'r': r}} ORDER BY lv) AS way FROM w GROUP BY lang, leaf),
f AS (SELECT o.doc_id, o.h AS leaf, s.h AS subroot, (SELECT h FROM c WHERE n = 1) AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
      list_reduce(list_concat([{{'l': '', 'r': o.now}}], coalesce(p.way, [])), lambda a, b: {{'l': '', 'r': sha256(b.l || a.r || b.r)}}).r AS folded_root
      FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang LEFT JOIN p ON p.lang IS NOT DISTINCT FROM o.lang AND p.leaf = o.i)
SELECT *, folded_root = root AS verified FROM f
"""
