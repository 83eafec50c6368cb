"""Documents to packed sequences: language, quality, exact and near copies, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm.best_fit import pack_documents
from quadrille.llm.content_sort import distinct_texts
from quadrille.llm.frames import stored_by, table
from quadrille.llm.language_masks import keep_identified
from quadrille.llm.minmax_dedup import near_duplicates
from quadrille.llm.queries import BYTE_BPE, quality_of

def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, and the key's name; ids may repeat or be null.

    The rows are dealt by the key before they are stored, so later joins on it move keys
    only, never texts.
    """
    key = "row"
    while key.lower() in map(str.lower, docs.columns):
        key += "_"
    return stored_by(docs.withColumn(key, F.monotonically_increasing_id()), key), key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no learned language, go."""
    return keep_identified(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely poor than good, by their text and their site, go."""
    rows, key = _keyed(docs)
    kept = quality_of(rows, table(spark, sf_dir, "labels"), key).where("kept").select(key)
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts stays, one with the largest id; a null id only if all are null."""
    return distinct_texts(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, one with the smallest id; a null id only if all are null."""
    rows, key = _keyed(docs)
    groups = near_duplicates(rows, id_col=key).select(key, "component_id").join(rows.select(key, "doc_id"), key)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    kept = groups.groupBy("component_id").agg(F.min_by(key, order).alias(key)).select(key)
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row for every piece of a document."""
    return pack_documents(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("quality", quality), ("exact", exact), ("near", near), ("packing", packed),
]

#: Language, quality and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
