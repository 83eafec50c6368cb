"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so half the hash evaluations give the same number of values.  Bands of the
signature make candidates; full shingle sets decide.

Rows with equal shingle sets are one class from the start, so copies never meet.  In a
bucket of a band one hub is compared with all members (a star, not all pairs).  Members
linked to one hub are one component, and members of one component needn't be compared.
What the stars leave open is compared exactly and without a cap, block against block:
a row holds two blocks of sets, a matrix product counts what they share, and only links
that join components leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.frames import components, slices, small_batches, spread_join
from quadrille.llm.words import shingles
from quadrille.plans.materialize import checkpointed

BANDS, ROWS = 30, 4
#: Documents of a block on average; a longer one counts once for every ``_LONG`` shingles.
_BLOCK, _LONG = 32, 4096
_RNG = np.random.Generator(np.random.PCG64(7))
_ODD = _RNG.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(h: np.ndarray, offsets: np.ndarray, values: int) -> np.ndarray:
    """``values`` columns for every non-empty set: minima of half as many permutations, then maxima."""
    half = (values + 1) // 2
    out = np.empty((values, len(offsets)), np.uint64)
    for k in range(half):
        p = h * _ODD[k]
        out[k] = np.minimum.reduceat(p, offsets)
        if half + k < values:
            out[half + k] = np.maximum.reduceat(p, offsets)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band and set; the number of the band is part of the key."""
    keys = np.empty((bands, sig.shape[1]), np.uint64)
    for b in range(bands):
        key = np.full(sig.shape[1], b + 1, np.uint64)
        for v in sig[b * rows : (b + 1) * rows]:
            key = (key ^ (v >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[b] = key
    return keys.view(np.int64)


def sketches(docs: DataFrame, size: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, n_shingles, set_id, keys``; without words ``set_id`` and ``keys`` are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, offsets = shingles(batch.column("text"), size)
                full = np.flatnonzero(np.diff(offsets))
                n, ids, keys = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, [None] * batch.num_rows
                if len(full):
                    found = band_keys(signature(h, offsets[:-1][full], bands * rows), bands, rows).T
                    for i, k in zip(full, found, strict=True):
                        own = np.unique(h[offsets[i] : offsets[i + 1]])
                        n[i], keys[i] = len(own), k
                        ids[i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(n), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "set_id", "keys"],
                )

    return docs.mapInArrow(run, "id long, n_shingles long, set_id binary, keys array<long>")


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, offsets = shingles(batch.column("text"), size)
                found = [np.unique(h[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets are similar enough."""
    joined = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.count_nonzero(q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p)
                keep[i] = 100 * both >= percent * (len(p) + len(q) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _open_links(member: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between documents that share a bucket but not yet a component.

    Documents gather at the component of the smallest hub they have met.  Those outside
    the main component there, and those of other gatherings that share a bucket with this
    one, are compared with everything in it, block against block.
    """
    comp = label.select(F.col("id").alias("rep"), F.col("component_id").alias("comp"))
    units = F.ceil(F.max("n") / _LONG).alias("units")
    met = member.groupBy("rep").agg(F.min("hub").alias("hub"), units)
    met = met.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    of_hub = comp.select(F.col("rep").alias("hub"), F.col("comp").alias("g"))
    at = spread_join(met, of_hub, "hub", "rep", "left").select("rep", "comp", "units", F.coalesce("g", "hub").alias("g"))
    at = checkpointed(at)
    crowd = at.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("units").alias("units"))
    main = crowd.groupBy("g").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("units").alias("size"))
    main = checkpointed(main)
    own = spread_join(at, main.select("g", "main"), "g", "rep").where("comp != main").select("g", "rep", "comp", "units")
    # buckets that join two gatherings
    held = member.select("key", "rep").join(at, "rep")
    sides = held.groupBy("key", "g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    several = sides.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("key")
    other = sides.join(several, "key", "left_semi").select("key", F.col("g").alias("to"), "lo", "hi")
    guests = (
        spread_join(held, other, "key", "rep").where("to < g and not (lo = comp and hi = comp)")
        .select(F.col("to").alias("g"), "rep", "comp", "units").distinct()
    )
    ask = checkpointed(own.unionByName(guests))
    asked = ask.groupBy("g").agg(F.sum("units").alias("asking")).join(main.select("g", "size"), "g")
    asked = checkpointed(
        asked.select("g", *(F.ceil(F.col(c) / _BLOCK).alias(n) for c, n in (("asking", "left"), ("size", "right"))))
    )
    left = _blocks(spread_join(ask, asked, "g", "rep"), "left", sets)
    right = _blocks(spread_join(at, asked, "g", "rep"), "right", sets)
    # each pair of blocks has a key of its own
    left = left.select("g", F.col("docs").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("right") - 1)).alias("q_number"))
    right = right.select("g", F.col("docs").alias("q"), F.col("number").alias("q_number"))
    met_blocks = left.join(right, ["g", "q_number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for p, q in zip(batch.column("p"), batch.column("q"), strict=True):
                for x, y in _block_links(p.values, q.values, percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return met_blocks.select("p", "q").mapInArrow(run, "a long, b long")


def _blocks(docs: DataFrame, blocks: str, sets: DataFrame) -> DataFrame:
    """``g, number, right, docs``: the documents of every gathering dealt to so many blocks, with their sets."""
    number = F.pmod(F.xxhash64("rep"), F.col(blocks))
    full = docs.select("g", "rep", "comp", "right", number.alias("number")).join(sets.withColumnRenamed("id", "rep"), "rep")
    return full.groupBy("g", "number").agg(
        F.first("right").alias("right"), F.collect_list(F.struct("rep", "comp", "shingles")).alias("docs")
    )


def _block_links(p: pa.StructArray, q: pa.StructArray, percent: int) -> list[tuple[int, int]]:
    """For every document of ``p``, one link to each other component of ``q`` that it is linked with."""
    sets = [[np.frombuffer(v.as_buffer(), np.uint64) for v in x.field("shingles")] for x in (p, q)]
    shared = np.intersect1d(*(np.unique(np.concatenate(x)) for x in sets), assume_unique=True)
    if not len(shared):
        return []
    inside = []
    for x in sets:
        m = np.zeros((len(x), len(shared)), np.float32)
        for i, s in enumerate(x):
            m[i, np.flatnonzero(np.isin(shared, s, assume_unique=True))] = 1
        inside.append(m)
    both = np.rint(inside[0] @ inside[1].T).astype(np.int64)
    size = [np.array([len(s) for s in x], np.int64) for x in sets]
    comp = [x.field("comp").to_numpy() for x in (p, q)]
    linked = 100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)
    linked &= comp[0][:, None] != comp[1][None, :]
    ids, found = [x.field("rep").to_numpy() for x in (p, q)], {}
    for i, j in np.argwhere(linked):
        found.setdefault((int(ids[0][i]), int(comp[1][j])), int(ids[1][j]))
    return [(a, b) for (a, _), b in found.items()]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept``: one row for every row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union`` of their sets of
    ``size``-word shingles.  ``component_id`` is the smallest id reachable over links, and
    ``kept`` marks the row that has it.  A null or wordless text has an empty set and is
    linked with nothing, not even with another one.  Ids must be unique and not null.
    Columns other than the two are ignored, whatever their names.  Empty input: no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketch = checkpointed(sketches(source, size, bands, rows))
    # equal sets are one class; its smallest id stands for it
    classes = sketch.where("set_id is not null").groupBy("set_id").agg(
        F.min_by("keys", "id").alias("keys"), F.min("id").alias("rep"), F.first("n_shingles").alias("n")
    )
    classes = checkpointed(classes)
    member = classes.select(F.col("rep"), F.col("n"), F.explode("keys").alias("key"))
    hubs = member.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("many")).where("many > 1")
    # rows of a bucket with two members or more
    member = checkpointed(member.join(hubs.select("key", "hub"), "key"))
    involved = member.select(F.col("rep").alias("id")).distinct()
    sets = checkpointed(_full_sets(source.join(involved, "id", "left_semi"), size))

    star = member.where("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    with small_batches(docs.sparkSession):
        links = checkpointed(_linked(star, sets, percent))
        label = checkpointed(components(links))
        more = checkpointed(_open_links(member, label, sets, percent))
    label = components(links.unionByName(more))
    of_class = classes.select("set_id", "rep").join(label.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_id", F.coalesce("component_id", "rep").alias("component_id")
    )
    out = sketch.select("id", "n_shingles", "set_id").join(of_class, "set_id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept")
    )
