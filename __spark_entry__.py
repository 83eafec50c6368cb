"""Registered queries: every operator on tables derived from the given data.

Coordinates are derived with integer arithmetic, so Spark and the SQL oracle see
the same doubles:  ``pts`` orders by (day, cents), ``items`` line items by (day,
cents), ``tr`` target rectangles from parts, ``qr`` query rectangles from
suppliers, ``emb`` the first two embedding axes.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import quadrille as qd  # noqa: E402
from quadrille.functions import predicates as P  # noqa: E402
from quadrille.plans.materialize import kept_folder, scratch_folder, shuffles_released  # noqa: E402

try:  # the subpackage for corpora, and the pipeline on it, may be absent
    import corpus_pipeline
    from quadrille.llm import queries as corpora
except ImportError as missing:
    import logging

    logging.getLogger(__name__).warning("the queries for corpora are left out: %s", missing)
    corpora = None

WINDOW = (400.0, 12000000.0, 100.0, 5000000.0)
_DAY0 = "1995-01-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(c: str) -> Column:
    return F.datediff(c, F.lit(_DAY0)).cast("double")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint").cast("double")


def as_points(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"), _day("o_orderdate").alias("x"), _cents("o_totalprice").alias("y")
    )


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_points(_table(spark, sf_dir, "orders"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), _day("l_shipdate").alias("x"), _cents("l_extendedprice").alias("y")
    )


def _rects(df: DataFrame, key: str, step: int, jump: int, w: Column, h: Column) -> DataFrame:
    k = F.col(key)
    x, y = (k * step) % 2400, (k * jump) % 500000 * 100
    return df.select(
        k.alias("id"), x.cast("double").alias("x1"), y.cast("double").alias("y1"),
        (x + w).cast("double").alias("x2"), (y + h).cast("double").alias("y2"),
    )


def tr(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return _rects(_table(spark, sf_dir, "part"), "p_partkey", 37, 7919, size, size * 20000)


def qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "supplier")
    return _rects(df, "s_suppkey", 53, 10007, F.lit(90), F.lit(2500000))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rectangles whose width and height take all powers of two up to 2 ** 11 and 2 ** 26."""
    return tr(spark, sf_dir).selectExpr(
        "id", "x1", "y1", "x1 + pow(2.0D, id % 12) AS x2", "y1 + pow(2.0D, id * 7 % 27) AS y2"
    )


def outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rectangles, the first of them larger than everything else together."""
    return tr(spark, sf_dir).selectExpr(
        "id", "IF(id = 1, -1e9D, x1) AS x1", "IF(id = 1, -1e12D, y1) AS y1",
        "IF(id = 1, 1e9D, x2) AS x2", "IF(id = 1, 1e12D, y2) AS y2",
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query rectangles that overlap a lot, every one seven times wider and higher."""
    return qr(spark, sf_dir).select(
        "id", "x1", "y1", (F.col("x1") + 630).alias("x2"), (F.col("y1") + 17500000).alias("y2")
    )


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"),
    )


def _text_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.concat_ws(",", *(F.col(c).cast("string") for c in columns)).alias("value"))


def _mixed_lines(spark: SparkSession, d: str) -> DataFrame:
    rects = _text_of(tr(spark, d), "id", "x1", "y1", "x2", "y2")
    return rects.unionByName(_text_of(pts(spark, d), "id", "x", "y"))


def _relations(spark: SparkSession, d: str) -> DataFrame:
    t, q = tr(spark, d), qr(spark, d).unionByName(tr(spark, d))
    found = {
        "contains": P.contains, "within": P.within, "equals": P.equals, "touches": P.touches,
    }
    parts = [
        qd.spatial_join(t, q, predicate=lambda a, b, f=f: P.intersects(a, b) & f(a, b)).withColumn(
            "relation", F.lit(name)
        )
        for name, f in found.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sql_predicates(spark: SparkSession, d: str) -> DataFrame:
    qd.register_sql_functions(spark)
    qd.spatial_join(tr(spark, d), qr(spark, d)).createOrReplaceTempView("quadrille_pairs")
    tr(spark, d).createOrReplaceTempView("quadrille_tr")
    qr(spark, d).createOrReplaceTempView("quadrille_qr")
    return spark.sql(
        """SELECT qid, tid,
             box_contains(q.x1, q.y1, q.x2, q.y2, t.x1, t.y1, t.x2, t.y2) AS contains,
             box_touches(q.x1, q.y1, q.x2, q.y2, t.x1, t.y1, t.x2, t.y2) AS touches,
             box_holds(q.x1, q.y1, q.x2, q.y2, t.x1, t.y1, t.x2, t.y2) AS holds,
             point_in_box(t.x1, t.y1, q.x1, q.y1, q.x2, q.y2) AS corner_inside
           FROM quadrille_pairs JOIN quadrille_qr q ON q.id = qid JOIN quadrille_tr t ON t.id = tid"""
    )


def _streamed(spark: SparkSession, d: str, step: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """Run ``step`` on the orders file as a stream; result of the finished stream.

    Every batch goes to its own folder, so a repeated batch replaces itself.  The result is
    read from these folders, not copied once more.  Pairs of a target repeat most of the pairs
    before them, which zstd packs far better than the default codec.
    """
    schema = _table(spark, d, "orders").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(d)
    result = step(as_points(stream))
    out = kept_folder(spark, "streamed")
    with scratch_folder(spark, "stream") as folder:

        def write(batch: DataFrame, number: int) -> None:
            part = f"batch={number}" if mode == "append" else "batch=all"
            batch.write.mode("overwrite").parquet(f"{out}/{part}", compression="zstd")

        run = (
            result.writeStream.foreachBatch(write).outputMode(mode)
            .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        )
        run.awaitTermination()
    return spark.read.schema(result.schema).parquet(out).select(*result.columns)


def _stream_range(spark: SparkSession, d: str) -> DataFrame:
    def step_range(points: DataFrame) -> DataFrame:
        return qd.range_query(points, WINDOW)

    return _streamed(spark, d, step_range, "append")


def _stream_join(spark: SparkSession, d: str) -> DataFrame:
    def step_join(points: DataFrame) -> DataFrame:
        return qd.spatial_join(points, qr(spark, d))

    return _streamed(spark, d, step_join, "append")


def _stream_count(spark: SparkSession, d: str) -> DataFrame:
    def step_count(points: DataFrame) -> DataFrame:
        return qd.spatial_count(points, qr(spark, d))

    return _streamed(spark, d, step_count, "complete")


def _from_files(
    spark: SparkSession, inputs: dict[str, DataFrame], step: Callable[[dict[str, str]], DataFrame],
    back: Callable[[SparkSession, str], DataFrame],
) -> DataFrame:
    """Text in, text out: ``inputs`` written as lines, ``step`` on their paths, its result written and read ``back``.

    The lines are packed and stay where they were written until the application ends: pairs
    may take far more room than the tables.  What was shuffled to write them goes at once.
    """
    out = f"{kept_folder(spark, 'lines')}/out"
    with scratch_folder(spark, "text") as folder, shuffles_released(spark):
        paths = {name: f"{folder}/{name}" for name in inputs}
        for name, lines in inputs.items():
            lines.write.text(paths[name])
        qd.write_lines(step(paths), out, compression="gzip")
    return back(spark, out)


def _value(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _bare_points(spark: SparkSession, path: str) -> DataFrame:
    return qd.read_points(spark, path, with_id=False)


def _range_from_file(spark: SparkSession, d: str) -> DataFrame:
    """The window is the lower left quarter of the points' extent; its corners are given the other way round."""
    half = pts(spark, d).agg(
        F.floor((F.min("x") + F.max("x")) / 2).cast("double").alias("x1"), F.min("y").alias("y1"),
        F.min("x").alias("x2"), F.floor((F.min("y") + F.max("y")) / 2).cast("double").alias("y2"),
    )
    return _from_files(
        spark, {"points": _text_of(pts(spark, d), "id", "x", "y"), "window": _text_of(half, "x1", "y1", "x2", "y2")},
        lambda at: qd.range_query(qd.read_points(spark, at["points"]), qd.read_window(spark, at["window"])), _value,
    )


def _join_from_files(spark: SparkSession, d: str) -> DataFrame:
    return _from_files(
        spark, {"boxes": _mixed_lines(spark, d), "queries": _text_of(qr(spark, d), "id", "x1", "y1", "x2", "y2")},
        lambda at: qd.spatial_join(qd.read_boxes(spark, at["boxes"]), qd.read_rects(spark, at["queries"])), _value,
    )


def _points_from_file(step: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: _from_files(
        s, {"points": _text_of(pts(s, d), "x", "y")}, lambda at: step(_bare_points(s, at["points"])), _bare_points
    )


def _union_from_file(spark: SparkSession, d: str) -> DataFrame:
    return _from_files(
        spark, {"rects": _text_of(tr(spark, d), "x1", "y1", "x2", "y2")},
        lambda at: qd.rect_union(qd.read_rects(spark, at["rects"], with_id=False)), _bare_points,
    )


def _lists_as_text(lists: DataFrame) -> DataFrame:
    return lists.select("qid", F.concat_ws(",", F.col("tids").cast("array<string>")).alias("tids"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "range_query": lambda s, d: qd.range_query(pts(s, d), WINDOW),
        "range_query_columns": lambda s, d: qd.range_query(
            _table(s, d, "lineitem"), (10, 20000, 20, 35000.5), "l_quantity", "l_extendedprice",
            ("l_orderkey", "l_linenumber"),
        ),
        "join_points": lambda s, d: qd.spatial_join(pts(s, d), qr(s, d)),
        "join_points_shuffle": lambda s, d: qd.spatial_join(pts(s, d), qr(s, d), strategy="shuffle"),
        "join_rects": lambda s, d: qd.spatial_join(tr(s, d), qr(s, d)),
        "join_rects_shuffle": lambda s, d: qd.spatial_join(tr(s, d), qr(s, d), strategy="shuffle"),
        "join_rects_mixed": lambda s, d: qd.spatial_join(mixed(s, d), qr(s, d)),
        "join_rects_outlier": lambda s, d: qd.spatial_join(outlier(s, d), qr(s, d)),
        "join_rects_self": lambda s, d: qd.spatial_join(tr(s, d), tr(s, d)),
        "join_left_pairs": lambda s, d: qd.spatial_join(tr(s, d), qr(s, d), how="left"),
        "join_left": lambda s, d: _lists_as_text(
            qd.spatial_join(tr(s, d), qr(s, d), how="left", output="lists")
        ),
        "join_lines": lambda s, d: qd.to_lines(
            qd.spatial_join(tr(s, d), qr(s, d), output="lists"), qr(s, d).select("id")
        ),
        "join_lines_points": lambda s, d: qd.to_lines(
            qd.spatial_join(pts(s, d), qr(s, d), output="lists"), qr(s, d).select("id")
        ),
        "join_parts": lambda s, d: _lists_as_text(
            qd.spatial_join(pts(s, d), qr(s, d), output="parts")
        ),
        "join_relations": _relations,
        "sql_predicates": _sql_predicates,
        "count_points": lambda s, d: qd.spatial_count(pts(s, d), qr(s, d)),
        "count_points_shuffle": lambda s, d: qd.spatial_count(pts(s, d), qr(s, d), strategy="shuffle"),
        "count_points_cells": lambda s, d: qd.spatial_count(items(s, d), wide(s, d), strategy="cells"),
        "count_items": lambda s, d: qd.spatial_count(items(s, d), wide(s, d)),
        "count_left": lambda s, d: qd.spatial_count(tr(s, d), qr(s, d), how="left"),
        "count_rects": lambda s, d: qd.spatial_count(tr(s, d), qr(s, d)),
        "count_lines": lambda s, d: qd.to_lines(qd.spatial_count(pts(s, d), qr(s, d))),
        "hull": lambda s, d: qd.convex_hull(pts(s, d)),
        "hull_emb": lambda s, d: qd.convex_hull(emb(s, d)),
        "hull_items": lambda s, d: qd.convex_hull(items(s, d)),
        "farthest": lambda s, d: qd.farthest_pair(pts(s, d)),
        "farthest_emb": lambda s, d: qd.farthest_pair(emb(s, d)),
        "closest": lambda s, d: qd.closest_pair(pts(s, d)),
        "closest_strips": lambda s, d: qd.closest_pair(pts(s, d), strips=6),
        "closest_emb": lambda s, d: qd.closest_pair(emb(s, d)),
        "closest_copies": lambda s, d: qd.closest_pair(_table(s, d, "lineitem"), "l_quantity", "l_tax"),
        "union_vertices": lambda s, d: qd.rect_union(tr(s, d)),
        "union_corners": lambda s, d: qd.rect_union(tr(s, d), corners_only=True),
        "union_dense": lambda s, d: qd.rect_union(wide(s, d)),
        "parse_points": lambda s, d: qd.parse_points(_text_of(pts(s, d), "id", "x", "y")),
        "parse_points_text_id": lambda s, d: qd.parse_points(
            _text_of(pts(s, d), "id", "x", "y", "id"), id_type="string"
        ),
        "parse_points_bare": lambda s, d: qd.parse_points(_text_of(emb(s, d), "x", "y"), with_id=False),
        "parse_rects": lambda s, d: qd.parse_rects(_text_of(tr(s, d), "id", "x1", "y1", "x2", "y2")),
        "parse_rects_bare": lambda s, d: qd.parse_rects(
            _text_of(tr(s, d), "x1", "y1", "x2", "y2"), with_id=False
        ),
        "parse_boxes": lambda s, d: qd.parse_boxes(_mixed_lines(s, d)),
        "stream_range": _stream_range,
        "stream_join": _stream_join,
        "stream_count": _stream_count,
        "range_from_file": _range_from_file,
        "join_from_files": _join_from_files,
        "hull_lines": _points_from_file(qd.convex_hull),
        "farthest_lines": _points_from_file(qd.farthest_pair),
        "closest_lines": _points_from_file(qd.closest_pair),
        "union_lines": _union_from_file,
    } | (corpora.queries() | {"pipeline": corpus_pipeline.run} if corpora else {})


def entry(spark: SparkSession) -> DataFrame:
    d = "/root/testdata/sf0.001"
    return qd.spatial_count(pts(spark, d), qr(spark, d), how="left")


_PTS = """pts AS (SELECT o_orderkey AS id,
  CAST(date_diff('day', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) AS DOUBLE) AS x,
  CAST(CAST(round(o_totalprice*100) AS BIGINT) AS DOUBLE) AS y FROM orders)"""
_ITEMS = """items AS (SELECT l_orderkey AS id,
  CAST(date_diff('day', TIMESTAMP '1995-01-01 00:00:00', l_shipdate) AS DOUBLE) AS x,
  CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS DOUBLE) AS y FROM lineitem)"""
_TR = """tr AS (SELECT p_partkey AS id,
  CAST((p_partkey*37)%2400 AS DOUBLE) AS x1, CAST((p_partkey*7919)%500000*100 AS DOUBLE) AS y1,
  CAST((p_partkey*37)%2400+p_size AS DOUBLE) AS x2,
  CAST((p_partkey*7919)%500000*100+20000*p_size AS DOUBLE) AS y2 FROM part)"""
_QR = """qr AS (SELECT s_suppkey AS id,
  CAST((s_suppkey*53)%2400 AS DOUBLE) AS x1, CAST((s_suppkey*10007)%500000*100 AS DOUBLE) AS y1,
  CAST((s_suppkey*53)%2400+90 AS DOUBLE) AS x2,
  CAST((s_suppkey*10007)%500000*100+2500000 AS DOUBLE) AS y2 FROM supplier)"""
_WIDE = f"{_QR}, wide AS (SELECT id, x1, y1, x1+630 AS x2, y1+17500000 AS y2 FROM qr)"
_EMB = """emb AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x,
  CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"""
_IN = "p.x BETWEEN q.x1 AND q.x2 AND p.y BETWEEN q.y1 AND q.y2"
_MEET = "q.x1 <= t.x2 AND t.x1 <= q.x2 AND q.y1 <= t.y2 AND t.y1 <= q.y2"
_OPEN = "q.x1 < t.x2 AND t.x1 < q.x2 AND q.y1 < t.y2 AND t.y1 < q.y2"
_INSIDE = "q.x1 <= t.x1 AND t.x2 <= q.x2 AND q.y1 <= t.y1 AND t.y2 <= q.y2"
_AROUND = "t.x1 <= q.x1 AND q.x2 <= t.x2 AND t.y1 <= q.y1 AND q.y2 <= t.y2"
_SAME = "q.x1 = t.x1 AND q.y1 = t.y1 AND q.x2 = t.x2 AND q.y2 = t.y2"
_TOUCH = f"({_MEET} AND NOT ({_OPEN}))"
_HOLDS = f"({_INSIDE} OR {_TOUCH})"


def _hull_sql(view: str, table: str) -> str:
    return f"""WITH {view},
u AS (SELECT x, max(y) y FROM {table} GROUP BY x), l AS (SELECT x, min(y) y FROM {table} GROUP BY x),
us AS (SELECT p.x, p.y, min(CASE WHEN q.x<p.x THEN (p.y-q.y)/(p.x-q.x) END) lft,
         max(CASE WHEN q.x>p.x THEN (q.y-p.y)/(q.x-p.x) END) rgt
       FROM u p LEFT JOIN u q ON q.x<>p.x GROUP BY p.x, p.y),
ls AS (SELECT p.x, p.y, max(CASE WHEN q.x<p.x THEN (p.y-q.y)/(p.x-q.x) END) lft,
         min(CASE WHEN q.x>p.x THEN (q.y-p.y)/(q.x-p.x) END) rgt
       FROM l p LEFT JOIN l q ON q.x<>p.x GROUP BY p.x, p.y)
SELECT x, y FROM us WHERE lft IS NULL OR rgt IS NULL OR lft > rgt
UNION SELECT x, y FROM ls WHERE lft IS NULL OR rgt IS NULL OR lft < rgt"""


def _pair_sql(view: str, table: str, order: str) -> str:
    return f"""WITH {view}, d AS (
  SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2,
    (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) AS d2
  FROM {table} a JOIN {table} b ON a.id <> b.id AND (a.x < b.x OR (a.x = b.x AND a.y <= b.y)))
SELECT x1, y1, x2, y2, sqrt(d2) AS distance FROM d ORDER BY d2 {order}, x1, y1, x2, y2 LIMIT 1"""


def _union_sql(view: str, table: str, kinds: str) -> str:
    def bit(c: str, v: int) -> str:
        return f"(CASE WHEN {c} THEN {v} ELSE 0 END)"

    bits = " | ".join(
        (
            bit("c.x<r.x2 AND c.y<r.y2", 1), bit("c.x>r.x1 AND c.y<r.y2", 2),
            bit("c.x>r.x1 AND c.y>r.y1", 4), bit("c.x<r.x2 AND c.y>r.y1", 8),
        )
    )
    return f"""WITH {view}, cand AS (
  SELECT x, y FROM (SELECT unnest([x1,x1,x2,x2]) x, unnest([y1,y2,y1,y2]) y FROM {table})
  UNION
  SELECT a.x, b.y FROM (SELECT x1 x, y1, y2 FROM {table} UNION ALL SELECT x2, y1, y2 FROM {table}) a
  JOIN (SELECT y1 y, x1, x2 FROM {table} UNION ALL SELECT y2, x1, x2 FROM {table}) b
    ON b.x1 < a.x AND a.x < b.x2 AND a.y1 < b.y AND b.y < a.y2),
m AS (SELECT c.x, c.y, bit_or({bits}) k
  FROM cand c JOIN {table} r ON c.x BETWEEN r.x1 AND r.x2 AND c.y BETWEEN r.y1 AND r.y2
  GROUP BY c.x, c.y),
o AS (SELECT x, y, CASE WHEN k IN (3,6,9,12) THEN 'collinear' ELSE 'corner' END AS kind
  FROM m WHERE k NOT IN (0,15))
SELECT x, y, kind FROM o{kinds}"""


def oracle_sql() -> dict[str, str]:
    def ends(order: str) -> str:
        pair = _pair_sql(_PTS, "pts", order)
        return f"SELECT x1 AS x, y1 AS y FROM ({pair}) UNION ALL SELECT x2, y2 FROM ({pair})"

    join_points = f"WITH {_PTS}, {_QR} SELECT q.id AS qid, p.id AS tid FROM pts p JOIN qr q ON {_IN}"
    join_rects = f"WITH {_TR}, {_QR} SELECT q.id AS qid, t.id AS tid FROM tr t JOIN qr q ON {_MEET}"
    count_points = (
        f"WITH {_PTS}, {_QR} SELECT q.id AS qid, count(*) AS n FROM pts p JOIN qr q ON {_IN} GROUP BY q.id"
    )
    count_items = (
        f"WITH {_ITEMS}, {_WIDE} SELECT q.id AS qid, count(*) AS n"
        f" FROM items p JOIN wide q ON {_IN} GROUP BY q.id"
    )
    in_window = f"WITH {_PTS} SELECT id FROM pts WHERE x BETWEEN 100 AND 400 AND y BETWEEN 5000000 AND 12000000"
    lists = "string_agg(CAST(tid AS VARCHAR), ',' ORDER BY tid)"
    relations = " UNION ALL ".join(
        f"SELECT q.id AS qid, t.id AS tid, '{name}' AS relation FROM tr t JOIN both_q q ON {cond}"
        for name, cond in (
            ("contains", _INSIDE), ("within", _AROUND), ("equals", _SAME), ("touches", _TOUCH)
        )
    )
    return {
        "range_query": in_window,
        "range_query_columns": "SELECT l_orderkey, l_linenumber FROM lineitem"
        " WHERE l_quantity BETWEEN 10 AND 20 AND l_extendedprice BETWEEN 20000 AND 35000.5",
        "join_points": join_points,
        "join_points_shuffle": join_points,
        "join_rects": join_rects,
        "join_rects_shuffle": join_rects,
        "join_rects_mixed": f"WITH {_TR}, {_QR}, mixed AS (SELECT id, x1, y1, x1 + pow(2.0, id % 12) AS x2,"
        f" y1 + pow(2.0, id * 7 % 27) AS y2 FROM tr) SELECT q.id AS qid, t.id AS tid FROM mixed t JOIN qr q ON {_MEET}",
        "join_rects_outlier": f"WITH {_TR}, {_QR}, outlier AS (SELECT id,"
        " CASE WHEN id = 1 THEN -1e9 ELSE x1 END AS x1, CASE WHEN id = 1 THEN -1e12 ELSE y1 END AS y1,"
        " CASE WHEN id = 1 THEN 1e9 ELSE x2 END AS x2, CASE WHEN id = 1 THEN 1e12 ELSE y2 END AS y2 FROM tr)"
        f" SELECT q.id AS qid, t.id AS tid FROM outlier t JOIN qr q ON {_MEET}",
        "join_rects_self": f"WITH {_TR} SELECT q.id AS qid, t.id AS tid FROM tr t JOIN tr q ON {_MEET}",
        "join_left_pairs": f"WITH {_TR}, {_QR} SELECT q.id AS qid, t.id AS tid"
        f" FROM qr q LEFT JOIN tr t ON {_MEET}",
        "join_left": f"WITH {_TR}, {_QR}, j AS (SELECT q.id AS qid, t.id AS tid"
        f" FROM qr q LEFT JOIN tr t ON {_MEET})"
        f" SELECT qid, coalesce({lists}, '') AS tids FROM j GROUP BY qid",
        "join_lines": f"SELECT CAST(qid AS VARCHAR) || ',' || {lists} AS value"
        f" FROM ({join_rects}) GROUP BY qid",
        "join_lines_points": f"SELECT CAST(qid AS VARCHAR) || ',' || {lists} AS value"
        f" FROM ({join_points}) GROUP BY qid",
        "join_parts": f"SELECT qid, {lists} AS tids FROM ({join_points}) GROUP BY qid",
        "join_relations": f"WITH {_TR}, {_QR},"
        f" both_q AS (SELECT * FROM qr UNION ALL SELECT * FROM tr) {relations}",
        "sql_predicates": f"WITH {_TR}, {_QR} SELECT q.id AS qid, t.id AS tid, ({_INSIDE}) AS contains,"
        f" {_TOUCH} AS touches, {_HOLDS} AS holds,"
        " (t.x1 BETWEEN q.x1 AND q.x2 AND t.y1 BETWEEN q.y1 AND q.y2) AS corner_inside"
        f" FROM tr t JOIN qr q ON {_MEET}",
        "count_points": count_points,
        "count_points_shuffle": count_points,
        "count_points_cells": count_items,
        "count_items": count_items,
        "count_left": f"WITH {_TR}, {_QR} SELECT q.id AS qid, count(t.id) AS n"
        f" FROM qr q LEFT JOIN tr t ON {_HOLDS} GROUP BY q.id",
        "count_rects": f"WITH {_TR}, {_QR} SELECT q.id AS qid, count(*) AS n"
        f" FROM tr t JOIN qr q ON {_HOLDS} GROUP BY q.id",
        "count_lines": f"SELECT CAST(qid AS VARCHAR) || ',' || CAST(n AS VARCHAR) AS value"
        f" FROM ({count_points})",
        "hull": _hull_sql(_PTS, "pts"),
        "hull_emb": _hull_sql(_EMB, "emb"),
        "hull_items": _hull_sql(_ITEMS, "items"),
        "farthest": _pair_sql(_PTS, "pts", "DESC"),
        "farthest_emb": _pair_sql(_EMB, "emb", "DESC"),
        "closest": _pair_sql(_PTS, "pts", "ASC"),
        "closest_strips": _pair_sql(_PTS, "pts", "ASC"),
        "closest_emb": _pair_sql(_EMB, "emb", "ASC"),
        "closest_copies": "SELECT x AS x1, y AS y1, x AS x2, y AS y2, CAST(0 AS DOUBLE) AS distance FROM"
        " (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_tax AS DOUBLE) AS y FROM lineitem)"
        " GROUP BY x, y HAVING count(*) > 1 ORDER BY x, y LIMIT 1",
        "union_vertices": _union_sql(_TR, "tr", ""),
        "union_corners": _union_sql(_TR, "tr", " WHERE kind = 'corner'"),
        "union_dense": _union_sql(_WIDE, "wide", ""),
        "parse_points": f"WITH {_PTS} SELECT id, x, y FROM pts",
        "parse_points_text_id": f"WITH {_PTS} SELECT CAST(id AS VARCHAR) AS id, x, y FROM pts",
        "parse_points_bare": f"WITH {_EMB} SELECT x, y FROM emb",
        "parse_rects": f"WITH {_TR} SELECT id, x1, y1, x2, y2 FROM tr",
        "parse_rects_bare": f"WITH {_TR} SELECT x1, y1, x2, y2 FROM tr",
        "parse_boxes": f"WITH {_TR}, {_PTS} SELECT id, x1, y1, x2, y2, false AS is_point FROM tr"
        " UNION ALL SELECT id, x, y, x, y, true FROM pts",
        "stream_range": in_window,
        "stream_join": join_points,
        "stream_count": count_points,
        "range_from_file": f"WITH {_PTS}, w AS (SELECT min(x) AS x1, floor((min(x) + max(x)) / 2) AS x2,"
        " min(y) AS y1, floor((min(y) + max(y)) / 2) AS y2 FROM pts)"
        " SELECT CAST(id AS VARCHAR) AS value FROM pts, w WHERE x BETWEEN x1 AND x2 AND y BETWEEN y1 AND y2",
        "join_from_files": f"WITH {_TR}, {_PTS}, {_QR},"
        " t AS (SELECT * FROM tr UNION ALL SELECT id, x, y, x, y FROM pts)"
        f" SELECT CAST(q.id AS VARCHAR) || ',' || CAST(t.id AS VARCHAR) AS value FROM t JOIN qr q ON {_MEET}",
        "hull_lines": _hull_sql(_PTS, "pts"),
        "farthest_lines": ends("DESC"),
        "closest_lines": ends("ASC"),
        "union_lines": f"SELECT x, y FROM ({_union_sql(_TR, 'tr', '')})",
    } | (corpora.oracle_sql() if corpora else {})
