"""Exact duplicates by sorting contents.

Sampled splitters range-partition the documents by (first bytes, digest, identifier) of
their normalised bytes, every partition is sorted externally, and each row is compared in
full with its neighbour; the digest only orders texts whose first bytes are equal.  The
identifier is part of the splitters' key, so a text with any number of copies spreads over
partitions; a run that may go on in a neighbouring partition is completed from run totals
and full texts, two for each partition at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, NullType, StructField, StructType

from quadrille.llm.frames import partitions
from quadrille.plans.materialize import checkpointed

_HEAD = 256
_SCHEMA = "id long, digest binary, keep long, n long, lead boolean, edge boolean, body binary"


def _plain(text: Column) -> Column:
    return text


def _cuts(body: pa.Array) -> list[int]:
    """Where runs of equal neighbours begin, and the end."""
    same = pc.equal(body.slice(1), body.slice(0, len(body) - 1)).to_pylist()
    return [0, *(i + 1 for i, x in enumerate(same) if not x), len(body)]


def _runs(keep_largest: bool):
    """Compares neighbours of a sorted partition; memory: one batch, and the ids of one run."""
    best = max if keep_largest else min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest, ids, first = None, None, [], True

        def closed(edge: bool) -> pa.RecordBatch:
            n, keep = len(ids), best((i for i in ids if i is not None), default=None)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([digest] * n, pa.binary()), pa.array([keep] * n, pa.int64()),
                    pa.array([n] * n, pa.int64()), pa.array([k == 0 for k in range(n)]), pa.array([edge] * n),
                    pa.array([last if edge and k == 0 else None for k in range(n)], pa.binary()),
                ],
                ["id", "digest", "keep", "n", "lead", "edge", "body"],
            )

        done: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            body = batch.column("body")
            begin = _cuts(body)
            numbers = batch.column("id").to_pylist()
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                value = body[a].as_py()
                if ids and (a or value != last):
                    done.append(closed(first))
                    ids, first = [], False
                if not ids:
                    digest = batch.column("digest")[a].as_py()
                ids.extend(numbers[a:b])
                last = value
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if ids:
            yield closed(True)

    return run


def _last_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last row of every run of equal neighbours; ``edge``: the run may go on in another partition."""
    part = TaskContext.get().partitionId()
    held, first = None, True

    def out(rows: pa.RecordBatch, edge: list[bool]) -> pa.RecordBatch:
        names = ["id", "digest", "row", "body"]
        flags = [pa.array(edge), pa.array([part] * len(edge), pa.int32())]
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *flags], [*names, "edge", "part"])

    for batch in batches:
        if not batch.num_rows:
            continue
        body = batch.column("body")
        begin = _cuts(body)
        if held is not None and held.column("body")[0].as_py() != body[0].as_py():
            yield out(held, [first])
            first = False
        ends = [b - 1 for b in begin[1:-1]]
        if ends:
            yield out(batch.take(pa.array(ends)), [first] + [False] * (len(ends) - 1))
            first = False
        held = batch.slice(batch.num_rows - 1)
    if held is not None:
        yield out(held, [True])


def _sorted(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column], extra: list[Column], up: bool) -> DataFrame:
    """``id, digest, body`` and ``extra``, range-partitioned and sorted; equal bodies by id, nulls first."""
    body = F.coalesce(normalise(F.col(text_col)), F.lit("")).cast("binary")
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("body"),
        F.substring(body, 1, _HEAD).alias("head"), *extra,
    )
    key = [F.col("head"), F.col("digest"), F.col("id").asc_nulls_first() if up else F.col("id").desc_nulls_first()]
    return source.repartitionByRange(partitions(docs.sparkSession), *key).sortWithinPartitions(*key).drop("head")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=_plain, keep: str = "smallest"
) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256``: one row for every row of ``docs``.

    ``normalise`` maps the text column; texts are equal when their normalised bytes are.
    ``keep`` is ``smallest`` or ``largest``: which id of equal texts stays.  A null text
    counts as empty, and the empty text has copies like any other.  Rows with the same id
    are separate copies; a null id is never the one that stays (``kept`` is false).  Other
    columns are ignored.  Empty input: no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    ordered = _sorted(docs, id_col, text_col, normalise, [], True)
    runs = checkpointed(ordered.mapInArrow(_runs(keep == "largest"), _SCHEMA))
    best = F.max if keep == "largest" else F.min
    # a run is counted at its first row, which carries its text at the edge of a partition
    open_runs = runs.where("edge and lead").groupBy("digest", "body").agg(
        F.sum("n").alias("total"), best("keep").alias("whole")
    ).drop("body")
    keep_id = F.coalesce("whole", "keep")
    return runs.drop("body").join(open_runs, "digest", "left").select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("total", "n").alias("group_size"),
        F.coalesce(F.col("id") == keep_id, F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=_plain, keep: str = "smallest"
) -> DataFrame:
    """``docs`` with one row of equal texts: the one with the ``smallest`` or ``largest`` id.

    Whole rows travel with the sort, so nothing is joined back.  A row with a null id stays
    only if the ids of all its copies are null; of rows with the same id any one stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    plain = normalise is _plain  # then the sorted bytes are the text
    carried = [
        f.name for f in docs.schema.fields if not isinstance(f.dataType, NullType) and not (plain and f.name == text_col)
    ]
    place = {c: f"c{i}" for i, c in enumerate(carried)}
    row = F.struct(F.col(text_col).isNull().alias("null"), *(F.col(f"`{c}`").alias(n) for c, n in place.items()))
    up = keep == "largest"
    ordered = _sorted(docs, id_col, text_col, normalise, [row.alias("row")], up)
    kind = StructType(
        [*(ordered.schema[c] for c in ("id", "digest", "row", "body")), StructField("edge", BooleanType()), StructField("part", IntegerType())]
    )
    ends = checkpointed(ordered.mapInArrow(_last_of_runs, kind))
    first = F.col("id") if up else F.bitwise_not("id")
    chosen = ends.where("edge").groupBy("digest", "body").agg(
        F.max_by("part", F.struct(F.col("id").isNotNull(), first)).alias("part")
    )
    # two rows of a partition at most
    at_edge = ends.where("edge").join(F.broadcast(chosen.select("digest", "part")), ["digest", "part"], "left_semi")
    kept = ends.where("not edge").select("row", "body").unionByName(at_edge.select("row", "body"))
    text = F.when(~F.col("row.null"), F.col("body").cast("string"))

    def column(field: StructField) -> Column:
        c = field.name
        own = F.col(f"row.{place[c]}") if c in place else text if plain and c == text_col else F.lit(None)
        return own.alias(c)

    return kept.select(*(column(f) for f in docs.schema.fields))
