"""Pairs of query boxes and targets (points or boxes) that share a point."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.predicates import Box, box_of
from ..functions.shapes import checked, coordinate_columns, keep_valid, to_box
from ..plans import bundles as bundling
from ..plans import grid
from ..plans.materialize import checkpointed

# Powers of two by which cells may be smaller than the queries.
_FINER_JOIN = range(1, 3)
# Target ids in one part of a long list.
_PART = 1_000_000


def as_boxes(
    df: DataFrame, columns: Sequence[str] | None, keep: Sequence[tuple[str, str]]
) -> tuple[DataFrame, bool]:
    """Valid rows as ``xmin, ymin, xmax, ymax`` plus kept columns (old, new).

    The second value tells whether the rows are points.
    """
    names = coordinate_columns(df, columns)
    box = to_box(names)
    return (
        keep_valid(df, names).select(
            *(c.alias(n) for c, n in zip(box, Box._fields)),
            *(F.col(old).alias(new) for old, new in keep),
        ),
        len(names) == 2,
    )


_FORCED_ROWS = 8 * grid._BROADCAST_ROWS  # more query cells than these are shuffled whatever the caller asks


def side_to_broadcast(
    strategy: str, layout: grid.Layout, targets: DataFrame, extents: grid.Extents | None
) -> str | None:
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError("strategy is 'auto', 'broadcast' or 'shuffle'")
    if strategy == "shuffle":
        return None
    if layout.query_cells <= (_FORCED_ROWS if strategy == "broadcast" else grid._BROADCAST_ROWS):
        return "queries"
    if strategy == "broadcast" or targets.isStreaming:
        return None
    limit = grid._BROADCAST_ROWS // len(layout.levels)
    rows = extents.rows * 9 if extents else targets.limit(limit + 1).count()
    return "targets" if rows <= limit else None


def _box_layout(targets: DataFrame, strategy: str, q_ext: grid.Extents) -> tuple[grid.Layout, grid.Extents | None]:
    """Layout for box targets, and their extents if they had to be measured.

    Few queries are placed on a level for every size that targets may have and sent
    everywhere, so the targets are read once.  Otherwise the targets that meet the
    window of the queries are measured first.
    """
    if targets.isStreaming:
        return grid.plan_layout(q_ext, None), None
    guess = None if strategy == "shuffle" else grid.any_size(q_ext)
    if guess is not None:
        layout = grid.plan_layout(q_ext, guess, unmeasured=True)
        if layout.query_cells <= grid._BROADCAST_ROWS:
            return layout, None
    extents = grid.measure(targets, (q_ext.xmin, q_ext.ymin, q_ext.xmax, q_ext.ymax))
    return grid.plan_layout(q_ext, extents if extents.rows else None), extents if extents.rows else None


def matched(
    targets: DataFrame,
    queries: DataFrame,
    points: bool,
    predicate: Callable[[Box, Box], Column],
    strategy: str,
    q_ext: grid.Extents,
    weigh: bool = False,
) -> DataFrame:
    """Joined rows (``t_``/``q_`` columns) that satisfy ``predicate``.

    ``predicate`` must imply that the closed boxes meet.  ``weigh`` adds ``t_n``, the
    number of equal targets a row stands for; a shuffled join then moves every
    distinct target once.
    """
    if points:
        layout, t_ext = grid.fine_layout(q_ext, _FINER_JOIN), None
    else:
        layout, t_ext = _box_layout(targets, strategy, q_ext)
    side = side_to_broadcast(strategy, layout, targets, t_ext)
    if weigh:
        if side is None and not targets.isStreaming:
            targets = grid.in_window(targets, layout).groupBy(targets.columns).agg(
                F.count(F.lit(1)).alias("n")
            )
        else:
            targets = targets.withColumn("n", F.lit(1).cast("long"))
    pairs = grid.meet(targets, queries, layout, points, side)
    return pairs.where(predicate(box_of("q_"), box_of("t_")))


def _in_parts(pairs: DataFrame, part_size: int, suspects: Callable[[DataFrame], DataFrame] = lambda p: p) -> DataFrame:
    """Number the parts of queries with more than ``part_size`` pairs by target id.

    Only the ``suspects`` among the pairs are counted.
    """
    zero = F.lit(0).cast("long")
    large = checkpointed(
        suspects(pairs).groupBy(*(c for c in pairs.columns if c != "tid")).count().where(F.col("count") > part_size)
        .select("qid", F.ceil(F.col("count") / part_size).alias("parts"))
    )
    found = large.count()
    if found == 0:
        return pairs.withColumn("part", zero)
    if found <= grid._BROADCAST_ROWS:
        large = F.broadcast(large)
    part = F.when(F.col("parts").isNull(), zero).otherwise(F.pmod(F.xxhash64("tid"), F.col("parts")))
    return pairs.join(large, "qid", "left").select(*pairs.columns, part.alias("part"))


def _bundled_lists(
    t: DataFrame, bundles: bundling.Bundles, points: bool, predicate: Callable[[Box, Box], Column],
    strategy: str, part_size: int | None, left: bool,
) -> DataFrame:
    """Lists gathered in the tasks of the bundles: targets move, pairs do not."""
    hits = matched(t, bundles.boxes, points, P.intersects, strategy, grid.measure(bundles.boxes))
    routed = hits.withColumnRenamed("q_bundle", "bundle")
    pairs, keys = bundling.pairs_of(bundles, routed, points, predicate, left), ["bundle", "qid"]
    if part_size is not None:
        # no query has more pairs than its bundle has targets for each of its rows
        rows = bundles.queries.groupBy("bundle", "qid").count().groupBy("bundle").agg(F.max("count").alias("rows"))
        full = checkpointed(
            routed.groupBy("bundle").count().join(rows.hint("merge"), "bundle")
            .where(F.col("count") * F.col("rows") > part_size).select("bundle")
        )
        if full.isEmpty():
            pairs = pairs.withColumn("part", F.lit(0).cast("long"))
        else:
            pairs = _in_parts(pairs, part_size, lambda p: p.join(F.broadcast(full), "bundle", "left_semi"))
        keys.append("part")
    return pairs.groupBy(*keys).agg(_ascending("tid")).drop("bundle")


def _ascending(tid: str) -> Column:
    return F.sort_array(F.collect_list(tid)).alias("tids")


def _no_target(pairs: DataFrame) -> Column:
    return F.lit(None).cast(pairs.schema["tid"].dataType).alias("tid")


def _without_match(everyone: DataFrame, pairs: DataFrame) -> DataFrame:
    """The query ids that occur in no pair, with a null target.

    The pairs are made once more to find them, but only the ids that a task has seen are
    moved: there may be far more pairs than rows in the tables.
    """
    seen = pairs.select(F.col("qid").alias("seen")).distinct()
    left = everyone.distinct().join(seen, F.col("qid").eqNullSafe(F.col("seen")), "left_anti")
    return left.select("qid", _no_target(pairs))


def spatial_join(
    targets: DataFrame,
    queries: DataFrame,
    how: str = "inner",
    output: str = "pairs",
    strategy: str = "auto",
    target_id: str = "id",
    query_id: str = "id",
    target_columns: Sequence[str] | None = None,
    query_columns: Sequence[str] | None = None,
    predicate: Callable[[Box, Box], Column] = P.intersects,
    part_size: int = _PART,
    on_bad: str = "drop",
    observation: Observation | None = None,
    query_observation: Observation | None = None,
) -> DataFrame:
    """For each query box the targets it meets (closed sets).

    output  ``pairs`` (qid, tid) -- the scalable form, one row per match
            ``lists`` (qid, tids ascending), one row per query id by definition
            ``parts`` (qid, part, tids ascending), lists of about ``part_size`` ids at
            most, for queries that may hold a large share of the targets
    how     ``left`` keeps queries without a match (null tid / empty list)
    strategy ``broadcast`` sends the query cells everywhere and never moves the
            targets (beyond a bound they are shuffled all the same); ``shuffle`` co-partitions both by cell and salts hot cells;
            ``auto`` measures the queries and decides by their number of cells.
    ``predicate(query, target)`` may be narrower than the default.
    ``on_bad='fail'`` refuses bad coordinates on either side; ``observation`` counts them
    among the targets, ``query_observation`` among the queries.
    """
    if how not in ("inner", "left") or output not in ("pairs", "lists", "parts"):
        raise ValueError("how is 'inner' or 'left', output is 'pairs', 'lists' or 'parts'")
    targets = checked(targets, coordinate_columns(targets, target_columns), on_bad, observation)
    queries = checked(queries, coordinate_columns(queries, query_columns), on_bad, query_observation)
    t, points = as_boxes(targets, target_columns, [(target_id, "tid")])
    q, _ = as_boxes(queries, query_columns, [(query_id, "qid")])
    extents = grid.measure(q)
    everyone = queries.select(F.col(query_id).alias("qid"))
    left = how == "left"
    if output != "pairs" and strategy != "broadcast" and not t.isStreaming and not (left and output == "parts"):
        bundles = bundling.in_bundles(q, extents)
        if bundles is not None:
            size = part_size if output == "parts" else None
            lists = _bundled_lists(t, bundles, points, predicate, strategy, size, left)
            if left:
                known = q.select(F.col("qid").alias("known")).distinct()
                bad = everyone.distinct().join(known, F.col("qid").eqNullSafe(F.col("known")), "left_anti")
                lists = lists.unionByName(bad.select("qid", F.array().cast(lists.schema["tids"].dataType).alias("tids")))
            return lists
    if extents.rows == 0:
        pairs = t.where(F.lit(False)).select(F.lit(None).cast(q.schema["qid"].dataType).alias("qid"), "tid")
    else:
        hits = matched(t, q, points, predicate, strategy, extents)
        pairs = hits.select(F.col("q_qid").alias("qid"), F.col("t_tid").alias("tid"))
    if output == "pairs":
        return pairs if how == "inner" else pairs.unionByName(_without_match(everyone, pairs))
    keys = ["qid"]
    if output == "parts":
        pairs, keys = _in_parts(pairs, part_size), ["qid", "part"]
    elif how == "left":
        # a null target adds a query, and nothing to its list
        pairs = pairs.unionByName(everyone.distinct().select("qid", _no_target(pairs)))
    lists = pairs.groupBy(*keys).agg(_ascending("tid"))
    if how == "left" and output == "parts":
        empty = F.array().cast(lists.schema["tids"].dataType)
        asked = everyone.distinct().withColumnRenamed("qid", "asked")
        lists = (
            asked.join(lists, F.col("asked").eqNullSafe(F.col("qid")), "left").drop("qid")
            .withColumnRenamed("asked", "qid").withColumn("tids", F.coalesce("tids", empty))
            .withColumn("part", F.coalesce("part", F.lit(0).cast("long")))
        )
    return lists
