"""The physical plans have the intended shape."""

import time

import __spark_entry__ as entry
import quadrille as qd
from pyspark.sql import functions as F
from quadrille.operators import spatial_join as join_module
from quadrille.plans import grid
from quadrille.plans.materialize import checkpointed, size_estimate_bits

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_is_pushed_down(spark):
    df = qd.range_query(
        spark.read.parquet(f"{SF}/lineitem.parquet"), (10, 1e4, 20, 2e4),
        "l_quantity", "l_extendedprice", ("l_orderkey",),
    )
    text = plan(df)
    assert "GreaterThanOrEqual(l_quantity,10.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in text


def test_join_plans(spark):
    t, q = entry.pts(spark, SF), entry.qr(spark, SF)
    sent = plan(qd.spatial_join(t, q, strategy="broadcast"))
    assert "BroadcastHashJoin" in sent and "Exchange hashpartitioning" not in sent
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = plan(qd.spatial_join(t, q, strategy="shuffle"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    assert "SortMergeJoin" in moved
    for text in (sent, moved):
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_count_is_partly_aggregated_before_its_shuffle(spark):
    text = plan(qd.spatial_count(entry.pts(spark, SF), entry.qr(spark, SF)))
    assert "partial_sum" in text


def test_window_of_the_queries_reaches_the_scan(spark):
    items = spark.read.parquet(f"{SF}/lineitem.parquet")
    q = spark.createDataFrame([(1, 10.0, 1e4, 20.0, 2e4)], "id long, x1 double, y1 double, x2 double, y2 double")
    text = plan(qd.spatial_count(items, q, target_columns=("l_quantity", "l_extendedprice")))
    assert "GreaterThanOrEqual(l_quantity,10.0)" in text


def test_size_estimates_do_not_grow_with_rounds(spark):
    rows = spark.range(50).selectExpr("id", "id % 7 as v")
    state = checkpointed(rows)
    for _ in range(30):
        top = state.groupBy("v").agg(F.max("id").alias("top"))
        state = checkpointed(state.join(top, "v").join(rows.select("id"), "id").select("id", "v"))
    assert size_estimate_bits(state) < 100 and state.count() == 50


def test_rectangles_are_read_once_if_the_queries_are_few(spark, monkeypatch):
    measured, plain = [], grid.measure
    monkeypatch.setattr(grid, "measure", lambda boxes, window=None: measured.append(window) or plain(boxes, window))
    t, q = entry.tr(spark, SF), entry.qr(spark, SF)
    text = plan(qd.spatial_join(t, q))
    assert measured == [None] and "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # otherwise only what meets the window of the queries is measured
    measured.clear()
    qd.spatial_join(t, q, strategy="shuffle")
    extents = plain(join_module.as_boxes(q, None, [])[0])
    assert measured == [None, (extents.xmin, extents.ymin, extents.xmax, extents.ymax)]


def test_layouts_of_unmeasured_targets(spark):
    # magnitudes from far below the queries to far above their window, flat and upright
    q = spark.createDataFrame(
        [(i, 10.0 * i, 7.0 * i, 10.0 * i + 3, 7.0 * i + 40) for i in range(40)],
        "id long, x1 double, y1 double, x2 double, y2 double",
    )
    t = spark.createDataFrame(
        [
            (i, -50.0 + 13 * i % 500, -60.0 + 11 * i % 450, -50.0 + 13 * i % 500 + 2.0 ** (i % 23 - 11),
             -60.0 + 11 * i % 450 + 2.0 ** (i * 5 % 29 - 14))
            for i in range(600)
        ],
        "id long, x1 double, y1 double, x2 double, y2 double",
    )
    boxes, asked = t.collect(), q.collect()
    want = sorted(
        (a.id, b.id) for a in asked for b in boxes if a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2
    )
    for strategy in ("auto", "broadcast", "shuffle"):
        assert sorted(map(tuple, qd.spatial_join(t, q, strategy=strategy).collect())) == want


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    def shuffle_files():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before, setting = shuffle_files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    dealt = spark.range(1000).repartition(3, "id")
    kept = checkpointed(dealt)
    for _ in range(50):  # executors delete them on their own time
        if shuffle_files() <= before:
            break
        time.sleep(0.2)
    assert shuffle_files() <= before
    assert sorted(r[0] for r in kept.collect()) == list(range(1000)) and dealt.count() == 1000
    assert spark.conf.get(setting) == was
