"""Registered queries of the operators, at production parameters over whole tables, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm.balanced_shards import shard_documents
from quadrille.llm.best_fit import pack_documents, vocabulary
from quadrille.llm.block_rules import extract
from quadrille.llm.collocations import collocations
from quadrille.llm.content_sort import exact_duplicates
from quadrille.llm.frames import table
from quadrille.llm.hard_negatives import hard_negatives
from quadrille.llm.language_masks import predict
from quadrille.llm.license_scan import SHINGLE, TEMPLATES, scan
from quadrille.llm.minmax_dedup import near_duplicates
from quadrille.llm.piece_merge import digests
from quadrille.llm.site_quality import score
from quadrille.llm.subspace_join import near_vectors
from quadrille.llm.toxicity import score as toxicity

BYTE_BPE = vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def quality_of(docs: DataFrame, labels: DataFrame, row_col: str | None = None) -> DataFrame:
    """A document's host is its source, its path there its language."""
    return score(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"), row_col=row_col)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), PIECES)


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 carry the next label."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), vec_id % 100 == 0)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_masks": language,
        "op2_balanced_shards": sharding,
        "op3_content_sort": exact_dedup,
        "op4_block_rules": main_texts,
        "op5_site_quality": quality,
        "op6_license_scan": licenses,
        "op7_minmax_dedup": minmax_dedup,
        "op8_best_fit": packing,
        "op9_subspace_join": vector_dedup,
        "op10_piece_merge": piece_coding,
        "op11_hard_negatives": mined_negatives,
        "op12_collocations": phrases,
        "op13_toxicity": toxic_documents,
    }


EXACT_SQL = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

NEAR_SQL = """WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE [w[i : i + 4] for i in range(1, len(w) - 3)] END) AS g FROM d),
n AS (SELECT d.doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 75 * (a.n + b.n - shared)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, min(r.y)) AS component_id,
  least(n.doc_id, min(r.y)) = n.doc_id AS kept
FROM n LEFT JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.n"""


VECTOR_SQL = """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
  AND len([x for x in e if x <> 0]) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x), c AS (SELECT x, min(y) AS m FROM r GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, c.m) AS component_id, least(vec_id, c.m) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id"""


NEGATIVES_SQL = """WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10"""


PHRASES_SQL = """WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM d),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, unnest([array_to_string(w[i : i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) AS phrase
  FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS m)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE m > 1 AND a >= 100),
k AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.lang = c.lang AND o.m > c.m AND 100 * o.a >= 100 * c.a
  AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
s AS (SELECT lang, phrase, a, unnest(range(1, m)) AS cut, string_split(phrase, ' ') AS w FROM k),
x AS (SELECT s.lang, s.phrase, s.a, cut, l.a AS l, r.a AS r, n,
    CAST(1000 * CAST(s.a AS HUGEINT) * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM s JOIN t ON t.lang = s.lang JOIN f AS l ON l.lang = s.lang AND l.phrase = array_to_string(w[1 : cut], ' ')
  JOIN f AS r ON r.lang = s.lang AND r.phrase = array_to_string(w[cut + 1 :], ' ')),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER u AS rank, phrase, a, l, r, n, score FROM y
WINDOW u AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER u <= 2000"""


def _license_sql() -> str:
    """Every template shingle looked up in every normalised text."""
    rows = []
    for i, (name, text) in enumerate(TEMPLATES):
        w = re.findall("[a-z0-9]+", text.lower())
        rows += {f"({i}, '{name}', ' {' '.join(w[k : k + SHINGLE])} ')" for k in range(len(w) - SHINGLE + 1)}
    return f"""WITH t(template, license, shingle) AS (VALUES {", ".join(sorted(rows))}),
n AS (SELECT template, count(*) AS n FROM t GROUP BY template),
d AS (SELECT doc_id, ' ' || regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g') || ' ' AS w FROM documents)
SELECT doc_id, license, template, count(*) AS n_found, count(*) / any_value(n) AS containment
FROM d JOIN t ON contains(w, shingle) JOIN n USING (template)
GROUP BY doc_id, license, template HAVING 100 * count(*) >= 75 * any_value(n)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_content_sort": EXACT_SQL,
        "op6_license_scan": _license_sql(),
        "op7_minmax_dedup": NEAR_SQL,
        "op9_subspace_join": VECTOR_SQL,
        "op11_hard_negatives": NEGATIVES_SQL,
        "op12_collocations": PHRASES_SQL,
    }
