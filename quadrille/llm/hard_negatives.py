"""Hard negatives by a secondary sort of scored pairs.

Anchors and rows are dealt to blocks; a task reads the anchors of a block pair first and
streams the rows past them.  What a task can settle stays there: of each stretch of rows
only the best positives of an anchor, and later only the best negatives in the window of
one of its positives, leave the task.

The scored pairs that are left carry one packed key, (anchor, descending score, kind, id,
row), whose bytes sort as the tuple does.  They are repartitioned by anchor and sorted
within partitions on that key (the DataFrame form of repartitionAndSortWithinPartitions),
and a streaming iterator walks over them: a positive opens its window, a negative is
emitted for each open window it falls into, and a window closes when it is full.  An
anchor's pairs are never materialised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.frames import partitions
from quadrille.plans.materialize import checkpointed

#: Most anchors and rows of a block; smaller blocks only give every task some work.
ANCHOR_BLOCK, ROW_BLOCK = 8192, 65536
_TILE = 256  # anchors scored at a time
_LEAST_BLOCK = 512
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8"), ("row", ">u8")])
_SIGN = np.uint64(1 << 63)
_PAIR = "anchor long, score long, id long, row long"


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the signed ones."""
    return x.astype(np.int64).view(np.uint64) ^ _SIGN


def _signed(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) ^ _SIGN).view(np.int64)


def packed_keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray, row: np.ndarray) -> list[bytes]:
    """Keys whose bytes sort by (anchor, descending score, kind, id, row)."""
    out = np.empty(len(anchor), _KEY)
    out["anchor"], out["score"], out["kind"] = _ordered(anchor), ~_ordered(score), kind
    out["id"], out["row"] = _ordered(ids), _ordered(row)
    data = out.tobytes()
    return [data[i : i + _KEY.itemsize] for i in range(0, len(data), _KEY.itemsize)]


def unpacked_keys(keys: pa.Array) -> dict[str, np.ndarray]:
    x = np.frombuffer(b"".join(keys.to_pylist()), _KEY)
    return {
        "anchor": _signed(x["anchor"]), "score": _signed(~x["score"].astype(np.uint64)), "kind": x["kind"],
        "id": _signed(x["id"]), "row": _signed(x["row"]),
    }


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integral vectors; in doubles as long as these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in x] for x in m], object) for m in (a, b)]
    out = whole[0] @ whole[1].T
    if out.min() < -(2**63) or out.max() >= 2**63:
        raise OverflowError("a score does not fit 64 bits")
    return out.astype(np.int64)


def _best(s: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the first ``k`` allowed entries of every line: higher scores, then smaller ids."""
    lowest = np.iinfo(np.int64).min
    masked = np.where(allowed, s, lowest)
    if masked.shape[1] > k:
        limit = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        allowed = allowed & (masked >= limit[:, None])
    i, j = np.nonzero(allowed)
    order = np.lexsort((rows[j], ids[j], ~s[i, j], i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    """``(anchors, rows)`` for stretches of rows of one block pair; anchors come first in a pair."""
    held, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("dims", "of_anchors", "of_rows")])
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0) | (asks[1:] != asks[:-1])) + 1
        for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            values = {c: part.column(c).to_numpy() for c in ("row", "id", "label")}
            flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float)
            values["x"] = np.floor(flat * part.column("scale")[0].as_py()).reshape(len(part), keys[0, a])
            values["scores"] = part.column("scores").to_pylist() if asks[a] else None
            if tuple(keys[:, a]) != key:
                held, key = None, tuple(keys[:, a])
            if not asks[a]:
                if held:
                    yield held, values
            elif held:
                held = {c: np.concatenate((held[c], v)) if c != "scores" else held[c] + v for c, v in values.items()}
            else:
                held = values


def _tiles(anchors: dict) -> Iterator[dict]:
    for a in range(0, len(anchors["row"]), _TILE):
        yield {c: v[a : a + _TILE] for c, v in anchors.items()}


def _pairs(anchors: dict, rows: dict, s: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    columns = (anchors["row"][i], s[i, j], rows["id"][j], rows["row"][j])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "score", "id", "row"])


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, rows in _stretches(batches):
            for t in _tiles(held):
                s = products(t["x"], rows["x"])
                allowed = (t["label"][:, None] == rows["label"]) & (t["row"][:, None] != rows["row"])
                yield _pairs(t, rows, s, *_best(s, allowed, rows["id"], rows["row"], k))

    return run


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest negative score for a positive's: low * score <= 100 * negative <= high * score."""
    return -(-low * score // 100), high * score // 100


def _negatives(k: int, positives: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, rows in _stretches(batches):
            for t in _tiles(held):
                s = products(t["x"], rows["x"])
                other = t["label"][:, None] != rows["label"]
                found = np.zeros(s.shape, bool)
                for p in range(positives):
                    ends = [window(x[p], low, high) if p < len(x) else (0, -1) for x in t["scores"]]
                    least, most = np.array(ends, np.int64).T
                    inside = other & (s >= least[:, None]) & (s <= most[:, None])
                    found[_best(s, inside, rows["id"], rows["row"], k)] = True
                yield _pairs(t, rows, s, *np.nonzero(found))

    return run


def _keyed(kind: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("anchor", "score", "id", "row")]
            keys = packed_keys(columns[0], columns[1], kind, *columns[2:])
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), pa.array(keys, pa.binary())], ["anchor", "key"])

    return run


def _walk(k: int, low: int, high: int):
    """Emits negatives from sorted keys; holds the open windows of one anchor."""
    names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            x = unpacked_keys(batch.column("key"))
            out: list[list] = [[] for _ in names]
            for anchor, score, kind, i in zip(*(x[c].tolist() for c in ("anchor", "score", "kind", "id")), strict=True):
                if anchor != current:
                    current, windows = anchor, []
                if not kind:
                    windows.append([i, score, *window(score, low, high), 0])
                    continue
                for w in windows:
                    if w[2] <= score <= w[3]:
                        w[4] += 1
                        for column, value in zip(out, (anchor, w[0], w[4], i, w[1], score), strict=True):
                            column.append(value)
                windows = [w for w in windows if w[4] < k]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return run


def _met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, row_block: int) -> DataFrame:
    """Each pair of an anchor block and a row block in one partition, its anchors before its rows."""
    n = partitions(rows.sparkSession)
    of_anchors = max(1, -(-n_anchors // ANCHOR_BLOCK))
    of_rows = max(1, -(-n_rows // row_block), min(n, -(-n_rows // _LEAST_BLOCK)))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        number = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(own)
        return df.select("*", number, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    both = dealt(anchors.withColumn("asks", F.lit(True)), "of_anchors", of_anchors, "of_rows", of_rows).unionByName(
        dealt(rows.withColumn("asks", F.lit(False)).withColumn("scores", F.lit(None).cast("array<long>")),
              "of_rows", of_rows, "of_anchors", of_anchors)
    )
    key = ["dims", "of_anchors", "of_rows"]
    return both.repartition(n, *key).sortWithinPartitions(*key, F.col("asks").desc())


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as ``floor(scale * x)``, a score is the integer inner product with
    the anchor; higher scores come first, then smaller ids.  An anchor's positives are its
    first ``positives`` other rows of the same label.  Of the rows with another label, the
    first ``negatives`` whose score lies between ``low`` and ``high`` per cent of a
    positive's are its hard negatives; ``rank`` counts them from 1.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part.  Vectors are compared with those of their length only.  Rows with the same id
    are separate rows, also as anchors; ``is_anchor`` is an expression over ``rows``, null
    is no.  Other columns are ignored.  A score beyond 64 bits raises an error.  Empty
    input, or no anchor: no rows.
    """
    exact = dict(rows.dtypes)[label_col] in ("tinyint", "smallint", "int", "bigint")
    label = F.col(label_col).cast("long") if exact else F.xxhash64(F.col(label_col).cast("string"))
    finite = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    used = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite
    base = checkpointed(
        rows.where(used).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.alias("label"),
            F.col(vector_col).alias("vector"), F.size(vector_col).alias("dims"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        )
    )
    counts = base.groupBy("is_anchor").count().collect()
    n_rows, n_anchors = sum(r[1] for r in counts), sum(r[1] for r in counts if r[0])
    plain = base.drop("is_anchor").withColumn("scale", F.lit(float(scale)))
    anchors = base.where("is_anchor").drop("is_anchor").withColumn("scale", F.lit(float(scale)))
    blank = F.lit(None).cast("array<long>")

    # the first pass: what every stretch of rows has best, then the best of these
    near = _met(anchors.withColumn("scores", blank), plain, n_anchors, n_rows, row_block).mapInArrow(
        _positives(positives), _PAIR
    )
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row"))
    near = checkpointed(near.withColumn("place", place).where(F.col("place") <= positives))
    scores = near.groupBy("anchor").agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    asking = anchors.join(scores.withColumnRenamed("anchor", "row"), "row")

    # the second pass: what lies in some window
    far = _met(asking, plain, n_anchors, n_rows, row_block).mapInArrow(_negatives(negatives, positives, low, high), _PAIR)
    pairs = near.drop("place").mapInArrow(_keyed(0), "anchor long, key binary").unionByName(
        far.mapInArrow(_keyed(1), "anchor long, key binary")
    )
    sorted_pairs = pairs.repartition(partitions(rows.sparkSession), "anchor").sortWithinPartitions("key")
    found = sorted_pairs.mapInArrow(
        _walk(negatives, low, high),
        "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
    names = base.where("is_anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

