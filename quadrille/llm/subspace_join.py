"""Near-duplicate vectors by a pigeonhole join over subspaces.

Unit vectors are rotated (a fixed orthogonal matrix, so distances stay) and split into
blocks of few dimensions.  Two vectors within squared distance ``t`` are within
``t / blocks`` in some block, so each block is range-joined under that budget: the first
coordinates of a block fall into cells, a vector stands in all cells that its box
touches, and the vectors of a cell are compared.  The union over blocks misses nothing.

A cell's vectors are dealt to chunks; a row holds two chunks, each pair of chunks with a key
of its own.  In a chunk the vectors are ordered by further coordinates of the block into
small tiles; tiles whose boxes are further apart than the budget are skipped, and of the
others only pairs within the block's budget become candidates, which are verified one by
one.  A pair counts once: in its first block within budget, in the first cell both stand
in.  Only counts and one link for each vector leave the task, never the pairs.  Equal
vectors are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.frames import components, small_batches
from quadrille.plans.materialize import checkpointed

BLOCK_DIMS, CELL_DIMS, CHUNK = 8, 3, 1024
_TILE, _SLABS = 32, 4  # vectors of a tile; slabs on each of the ordering coordinates
_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(dims: int) -> np.ndarray:
    if dims not in _ROTATIONS:
        _ROTATIONS[dims] = np.linalg.qr(np.random.Generator(np.random.PCG64(11)).normal(size=(dims, dims)))[0]
    return _ROTATIONS[dims]


def _bounds(dims: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK_DIMS, dims)) for a in range(0, dims, BLOCK_DIMS)]


def _budget(dims: int, cosine: float) -> float:
    """Of one block; a little more than its part, for rounding."""
    return (2 - 2 * cosine) / len(_bounds(dims)) * (1 + 1e-6) + 1e-12


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _standing(cosine: float):
    """Rows ``(block, cell, low, id, many, label, vector)``, one for each cell a vector stands in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("vector").value_lengths().to_numpy()
            for dims in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dims))
                x = part.column("vector").flatten().to_numpy().astype(float).reshape(-1, dims)
                turned, reach = _unit(x) @ rotation(int(dims)), _budget(int(dims), cosine) ** 0.5
                for block, (a, b) in enumerate(_bounds(int(dims))):
                    low, high = (
                        np.floor((turned[:, a : min(b, a + CELL_DIMS)] + s * reach / 2) / (2 * reach)).astype(np.int32)
                        for s in (-1, 1)
                    )
                    for corner in range(1 << low.shape[1]):
                        on = np.array([corner >> k & 1 for k in range(low.shape[1])], bool)
                        at = np.flatnonzero(((low != high) | ~on).all(1))
                        if not len(at):
                            continue
                        cell = np.where(on, high[at], low[at])
                        chosen = part.take(pa.array(at))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(at), block, np.int32)), pa.array(cell.tolist(), pa.list_(pa.int32())),
                                pa.array(low[at].tolist(), pa.list_(pa.int32())),
                                *(chosen.column(c) for c in ("id", "many", "label", "vector")),
                            ],
                            ["block", "cell", "low", "id", "many", "label", "vector"],
                        )

    return run


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            columns = [batch.column(c) for c in ("block", "cell", "same", "p", "q")]
            for block, cell, same, p, q in zip(*columns, strict=True):
                for column, values in zip(
                    out, _chunk_links(block.as_py(), np.array(cell.as_py()), same.as_py(), p.values, q.values, cosine),
                    strict=True,
                ):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["id", "n", "root"])

    return run


def _tiles(x: np.ndarray) -> np.ndarray:
    """Row numbers in tiles of ``_TILE``, neighbours on the coordinates behind the cell's; -1 fills the last tiles up."""
    n, order = len(x), np.arange(len(x))
    axes = range(CELL_DIMS, min(x.shape[1], CELL_DIMS + 3))
    size = n
    groups = [order]
    for axis in axes:
        if size <= _TILE:
            break
        groups = [g for part in groups for g in np.array_split(part[np.argsort(x[part, axis], kind="stable")], _SLABS)]
        size = -(-size // _SLABS)
    out = []
    for g in groups:
        padded = np.full(-(-len(g) // _TILE) * _TILE, -1)
        padded[: len(g)] = g
        out.append(padded)
    return np.concatenate(out).reshape(-1, _TILE)


def _close(p: np.ndarray, q: np.ndarray, budget: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``budget`` of squared distance, found tile by tile; ``same``: each pair once."""
    tiles = [_tiles(x) for x in (p, q)]
    points = [np.where(t[:, :, None] < 0, np.inf, x[t]) for t, x in zip(tiles, (p, q), strict=True)]
    low = [x.min(1) for x in points]
    high = [np.where(np.isinf(x), -np.inf, x).max(1) for x in points]
    gap = np.maximum(0, np.maximum(low[0][:, None] - high[1][None], low[1][None] - high[0][:, None]))
    near = np.argwhere((gap**2).sum(2) <= budget)
    if same:
        near = near[near[:, 0] <= near[:, 1]]
    filled = [np.where(np.isinf(x), s * 1e9, x) for x, s in zip(points, (1, -1), strict=True)]
    square = [(x * x).sum(2) for x in filled]
    for k in range(0, len(near), 64):
        a, b = near[k : k + 64].T
        d = square[0][a][:, :, None] + square[1][b][:, None, :] - 2 * filled[0][a] @ filled[1][b].transpose(0, 2, 1)
        t, i, j = np.nonzero(d <= budget + 1e-9)
        i, j, diagonal = tiles[0][a[t], i], tiles[1][b[t], j], a[t] == b[t]
        once = ~diagonal | (i < j) if same else slice(None)
        yield i[once], j[once]


def _chunk_links(
    block: int, cell: np.ndarray, same: bool, p: pa.StructArray, q: pa.StructArray, cosine: float
) -> tuple[list, list, list]:
    """For each vector with links between the chunks: id, number of links, smallest id it is connected with here."""
    ids, many, low, x = zip(*(_arrays(c) for c in (p, q)), strict=True)
    length = [np.linalg.norm(v, axis=1) for v in x]
    dims = x[0].shape[1]
    turned = [v / n[:, None] @ rotation(dims) for v, n in zip(x, length, strict=True)]
    bounds, budget = _bounds(dims), _budget(dims, cosine)
    a, b = bounds[block]
    linked = []
    for i, j in _close(turned[0][:, a:b], turned[1][:, a:b], budget, same):
        ok = (np.maximum(low[0][i], low[1][j]) == cell).all(1)
        i, j = i[ok], j[ok]
        gap = (turned[0][i] - turned[1][j]) ** 2
        within = np.stack([gap[:, c:d].sum(1) <= budget for c, d in bounds])
        ok = within.any(0) & (within.argmax(0) == block)
        ok &= np.sum(x[0][i] * x[1][j], axis=1) / (length[0][i] * length[1][j]) >= cosine
        linked.append(np.stack((i[ok], j[ok])))
    i, j = np.concatenate(linked, axis=1) if linked else np.zeros((2, 0), np.int64)
    if not len(i):
        return [], [], []
    every, where = np.unique(np.concatenate((ids[0][i], ids[1][j])), return_inverse=True)
    a, b = where[: len(i)], where[len(i) :]
    n = np.bincount(a, many[1][j], len(every)) + np.bincount(b, many[0][i], len(every))
    root = np.arange(len(every))
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return every.tolist(), n.astype(np.int64).tolist(), every[root].tolist()


def _arrays(chunk: pa.StructArray) -> tuple[np.ndarray, ...]:
    n = len(chunk)
    flat = [chunk.field(c).flatten().to_numpy().reshape(n, -1) for c in ("low", "vector")]
    return chunk.field("id").to_numpy(), chunk.field("many").to_numpy(), flat[0], flat[1].astype(float)


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98
) -> DataFrame:
    """``id_col, n_links, component_id, kept``: one row for every row of ``rows``.

    Vectors of equal, non-null label and equal length are linked when their cosine, in
    double precision, is ``cosine`` (over 0) or more.  Null, empty or zero vectors and those with a
    null or non-finite component are linked with nothing; so is a row with a null id, which
    is not compared.  Rows with the same id and vector are copies of each other; other
    columns are ignored.  Empty input: no rows.
    """
    source = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    )
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = (
        F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    )
    # a vector with huge or tiny components keeps its direction in double precision
    source = source.select(
        "id", F.when(usable, F.col("label")).alias("label"),
        F.when(usable, F.col("vector").cast("array<double>")).alias("vector"),
    )
    good = source.where("label is not null and vector is not null and id is not null")
    classes = checkpointed(
        good.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("many"))
    )
    standing = checkpointed(
        classes.select(F.col("rep").alias("id"), "many", "label", F.col("vector").cast("array<float>").alias("vector"))
        if dict(rows.dtypes)[vector_col] == "array<float>"
        else classes.select(F.col("rep").alias("id"), "many", "label", "vector")
    )
    kind = dict(standing.dtypes)["vector"]
    placed = standing.mapInArrow(
        _standing(cosine),
        f"block int, cell array<int>, low array<int>, id long, many long, label string, vector {kind}",
    ).withColumn("dims", F.size("vector"))
    key = ["label", "dims", "block", "cell"]
    placed = checkpointed(placed)
    crowd = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    parts = F.ceil(F.col("crowd") / CHUNK)
    chunks = checkpointed(
        placed.join(crowd, key).select(
            *key, parts.alias("parts"), F.pmod(F.xxhash64("id"), parts).alias("number"),
            F.struct("id", "many", "low", "vector").alias("row"),
        )
        .groupBy(*key, "number").agg(F.first("parts").alias("parts"), F.collect_list("row").alias("rows"))
    )
    zero, last = F.lit(0).cast("long"), F.col("parts") - 1
    p = chunks.select(*key, "number", F.explode(F.sequence(F.col("number"), last)).alias("other"), F.col("rows").alias("p"))
    q = chunks.select(*key, F.explode(F.sequence(zero, F.col("number"))).alias("number"), F.col("number").alias("other"), F.col("rows").alias("q"))
    met = p.join(q, [*key, "number", "other"]).select(
        "block", "cell", (F.col("number") == F.col("other")).alias("same"), "p", "q"
    )
    with small_batches(rows.sparkSession, 16):
        found = checkpointed(met.mapInArrow(_compare(cosine), "id long, n long, root long"))
        label = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("id").agg(F.sum("n").alias("n"))
    of_class = (
        classes.select("rep", "many", "label", "vector").join(totals.withColumnRenamed("id", "rep"), "rep", "left")
        .join(label.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "label", "vector", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "id")
    return source.join(of_class, ["label", "vector"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (component == F.col("id")).alias("kept"),
    )
