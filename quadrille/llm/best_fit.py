"""Best-fit decreasing packing of token sequences.

Sizes are integers up to the capacity, so the packing itself works on a histogram of
sizes, which has at most ``capacity`` entries whatever the corpus.  Sizes go from large to
small; a segment tree over remaining capacities finds the tightest open bin in logarithmic
time, and bins with equal content are handled as one range, which gives the bins that
placing one document after the other gives.  The plan is a list of rank intervals; each
piece finds its interval by its rank among the pieces of its size.
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille.llm.frames import partitions
from quadrille.plans.materialize import checkpointed

CAPACITY = 2048
#: The published split pattern of the vocabulary, with possessive quantifiers: same pieces, less backtracking.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
Interval = tuple[int, int, int, int, int, int]


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary: lines of base64 bytes and rank, and tokens added to it, recognised inside texts."""

    ranks: str
    added: tuple[tuple[str, int], ...] = ()


def vocabulary(ranks: str, tokenizer: str) -> Vocabulary:
    """Ranks with the added tokens of a tokenizers file for the same vocabulary."""
    with open(tokenizer, encoding="utf-8") as f:
        return Vocabulary(ranks, tuple((t["content"], t["id"]) for t in json.load(f)["added_tokens"]))


@cache
def encoder(words: Vocabulary) -> Callable[[str], list[int]]:
    """The ids that the tokenizers library gives without tokens around the text, in a third of its time."""
    import tiktoken

    with open(words.ranks, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(words.added))
    return partial(library.encode, allowed_special="all")


class Tightest:
    """Segment tree over the capacities 0 to ``top``: which of them some open bin has left."""

    def __init__(self, top: int) -> None:
        self.size = 1 << top.bit_length()
        self.some = bytearray(2 * self.size)

    def put(self, capacity: int, open_bins: bool) -> None:
        i = capacity + self.size
        self.some[i] = open_bins
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] | self.some[2 * i + 1]

    def at_least(self, need: int) -> int | None:
        """Smallest capacity from ``need`` on that an open bin has left."""
        i = need + self.size
        if self.some[i]:
            return need
        while i > 1:
            if not i % 2 and self.some[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i + (not self.some[2 * i])
                return i - self.size
            i //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[Interval]:
    """Intervals ``(size, rank_from, rank_to, first_bin, per_bin, offset)``.

    The piece of rank r in an interval goes to bin ``first_bin + (r - rank_from) // per_bin``.
    """
    ranges: dict[int, list[tuple[int, int]]] = {}
    tree, plan, bins = Tightest(capacity), [], 0

    def put(left: int, first: int, n: int) -> None:
        if n:
            ranges.setdefault(left, []).append((first, n))
            tree.put(left, True)

    for size in sorted(counts, reverse=True):
        if not 0 < size <= capacity:
            raise ValueError(f"size {size} is not within 1 to {capacity}")
        todo, rank = counts[size], 0
        while todo:
            left = tree.at_least(size)
            if left is None:
                left, first = capacity, bins
                n = -(-todo // (capacity // size))
                bins += n
            else:
                first, n = ranges[left].pop()
                if not ranges[left]:
                    tree.put(left, False)
            each = left // size
            full = min(n, todo // each)
            if full:
                plan.append((size, rank, rank + full * each, first, each, capacity - left))
                put(left - each * size, first, full)
            rank, todo, first, n = rank + full * each, todo - full * each, first + full, n - full
            if todo and n:  # one bin takes what is left of this size
                plan.append((size, rank, rank + todo, first, todo, capacity - left))
                put(left - todo * size, first, 1)
                todo, first, n = 0, first + 1, n - 1
            put(left, first, n)
    return plan


def pieces(
    docs: DataFrame, words: Vocabulary, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32[, ids]``: token ids and the end id, cut only beyond ``capacity``.

    All pieces but the first have ``capacity`` tokens.  A null text counts as empty: one
    piece with the end id.
    """
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(words)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                a, b, k = 0, len(ids) % capacity or capacity, 0
                while a < len(ids):
                    part = ids[a:b] if b - a < len(ids) else ids
                    row = [i, k, a, b - a, zlib.crc32(array("I", part))] + [part] * with_ids
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    a, b, k = b, b + capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names
            )

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, schema)


def _ranked(parts: DataFrame) -> DataFrame:
    """``rank`` from 0 among the pieces of equal length, without a task for any one length."""
    cells = partitions(parts.sparkSession)
    dealt = parts.withColumn("cell", F.pmod(F.xxhash64("id", "piece"), F.lit(cells)))
    counts = dealt.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "cell").orderBy("id", "piece", "ids_crc32")
    return dealt.withColumn("own", F.row_number().over(own)).join(counts, ["length", "cell"]).withColumn(
        "rank", F.col("before") + F.col("own") - 1
    ).drop("cell", "own", "before")


def _plan_frame(spark: SparkSession, plan: list[Interval]) -> DataFrame:
    schema = "length long, rank_from long, rank_to long, first_bin long, per_bin long, base long"
    return spark.createDataFrame(plan, schema)


def best_fit(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset`` (its place there, gapless from 0).

    ``parts`` has ``id, piece, length, ids_crc32``; it is read twice, so it should be
    checkpointed.  The driver holds one count for each length.  Empty input: no rows.
    """
    counts = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}
    plan = F.broadcast(_plan_frame(parts.sparkSession, best_fit_plan(counts, capacity)))
    ranked = _ranked(parts).alias("r").join(
        plan.alias("p"),
        (F.col("r.length") == F.col("p.length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    step = F.col("rank") - F.col("rank_from")
    return ranked.select(
        *(F.col("r." + c) for c in parts.columns),
        (F.col("first_bin") + F.floor(step / F.col("per_bin"))).alias("sequence_id"),
        (F.col("base") + F.pmod(step, F.col("per_bin")) * F.col("r.length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, words: Vocabulary, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32[, ids], sequence_id, offset``: one row for every piece.

    Ids may repeat (each row is packed); extra columns of ``docs`` are ignored.
    """
    parts = checkpointed(pieces(docs, words, id_col, text_col, capacity, end_id, with_ids))
    return best_fit(parts, capacity).withColumnRenamed("id", id_col)
