"""Plans that stay within their bounds when the tables grow."""

import os
import time

import __spark_entry__ as entry
import pytest
import quadrille as qd
from quadrille.plans import grid
from quadrille.sources import text as text_module

SF = "/root/testdata/sf0.001"
BOX = "id long, x1 double, y1 double, x2 double, y2 double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffled_sides_are_not_sent_whole(spark):
    # the estimates of cells are those of the small tables they come from
    for t, q in ((entry.tr, entry.tr), (entry.tr, entry.qr), (entry.pts, entry.qr)):
        text = plan(qd.spatial_join(t(spark, SF), q(spark, SF), strategy="shuffle"))
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_union_sends_no_side_whole(spark):
    text = plan(qd.rect_union(entry.tr(spark, SF)))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_many_query_cells_meet_small_tables_on_every_core(spark, monkeypatch):
    t, q = entry.tr(spark, SF), entry.qr(spark, SF)
    want = sorted(map(tuple, qd.spatial_join(t, q).collect()))
    monkeypatch.setattr(grid, "_SPREAD_CELLS", 1)
    for targets in (t, entry.pts(spark, SF)):
        assert "RoundRobinPartitioning" in plan(qd.spatial_join(targets, q))
    assert sorted(map(tuple, qd.spatial_join(t, q).collect())) == want


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_left_pairs_are_not_moved(spark, strategy):
    t = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (None, 1.0, 1.0, 3.0, 3.0), (3, 8.0, 8.0, 9.0, 9.0)], BOX)
    q = spark.createDataFrame(
        [(1, 0.0, 0.0, 1.0, 1.0), (1, 5.0, 5.0, 6.0, 6.0), (2, 5.0, 5.0, 6.0, 6.0), (2, 5.0, 5.0, 6.0, 6.0),
         (None, 2.5, 2.5, 3.0, 3.0), (4, float("nan"), 0.0, 1.0, 1.0)],
        BOX,
    )
    left = qd.spatial_join(t, q, how="left", strategy=strategy)
    assert "LeftOuter" not in plan(left)

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(left) == sorted([(1, 1), (1, None), (2, None), (None, None), (4, None)], key=str)
    lists = qd.spatial_join(t, q, how="left", output="lists", strategy=strategy)
    assert "LeftOuter" not in plan(lists)
    assert rows(lists) == sorted([(1, [1]), (2, []), (None, []), (4, [])], key=str)


def test_lines_are_split_once(spark):
    lines = spark.createDataFrame([("1,2,3,4,5,,",), ("2,3,4",)], "value string")
    for parsed in (qd.parse_boxes(lines), qd.parse_points(lines), qd.parse_rects(lines)):
        assert plan(parsed.where("id > 0")).count("split(") == 1


def test_results_in_files_are_not_copied(spark):
    for name in ("stream_range", "hull_lines"):
        text = plan(entry.queries()[name](spark, SF))
        assert "FileScan" in text and "ExistingRDD" not in text


def test_inner_cells_are_not_listed_one_by_one(spark, monkeypatch):
    items, wide = entry.items(spark, SF), entry.wide(spark, SF)
    want = sorted(map(tuple, qd.spatial_count(items, wide, strategy="shuffle").collect()))
    listed, plain = [], grid.query_cells
    monkeypatch.setattr(grid, "query_cells", lambda *a: listed.append(plain(*a)) or listed[-1])
    for limit in (grid._BROADCAST_ROWS, 1):
        monkeypatch.setattr(grid, "_BROADCAST_ROWS", limit)
        found = qd.spatial_count(items, wide, strategy="cells")
        assert sorted(map(tuple, found.collect())) == want
        cells = listed[-1][0]
        assert cells.where("cx > cx0 AND cx < cx1 AND cy > cy0 AND cy < cy1").isEmpty()


def test_cells_become_smaller_with_the_points(spark, monkeypatch):
    from quadrille.operators import spatial_count as count_module

    points = spark.range(40000).selectExpr("double(id % 200) AS x", "double(id div 200) AS y")
    q = spark.createDataFrame([(None if i == 3 else i % 5, 9.0 * i, 7.0 * i, 9.0 * i + 90, 7.0 * i + 80) for i in range(12)], BOX)
    want = sorted(map(tuple, qd.spatial_count(points, q, strategy="shuffle").collect()), key=str)
    monkeypatch.setattr(grid, "_BROADCAST_ROWS", 1)
    layouts, plain = [], count_module._cells_layout
    monkeypatch.setattr(count_module, "_cells_layout", lambda *a: layouts.append(plain(*a)) or layouts[-1])
    for share in (0.001, 10.0):
        monkeypatch.setattr(count_module, "_BORDER_SHARE", share)
        assert sorted(map(tuple, qd.spatial_count(points, q, strategy="cells").collect()), key=str) == want
    assert [layout.finer for layout in layouts] == [3, 8]


def test_batches_of_a_stream_are_packed(spark, tmp_path):
    # all supplier keys make the same rectangle, with every order in it
    spark.range(2000).selectExpr(
        "id * 37 % 100003 AS o_orderkey", "timestamp '1995-01-01' + make_dt_interval(int(id % 90)) AS o_orderdate",
        "double(id * 7 % 25000) AS o_totalprice",
    ).coalesce(1).write.parquet(str(tmp_path / "made"))
    next((tmp_path / "made").glob("*.parquet")).rename(tmp_path / "orders.parquet")
    spark.range(100).selectExpr("id * 1500000 AS s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    found = entry.queries()["stream_join"](spark, str(tmp_path))
    kept = sum(os.path.getsize(name.removeprefix("file://")) for name in found.inputFiles())
    found.coalesce(1).write.parquet(str(tmp_path / "plain"))
    plain = sum(f.stat().st_size for f in (tmp_path / "plain").glob("*.parquet"))
    assert found.count() == 200000 == found.distinct().count() and kept < 0.6 * plain


def test_lists_are_computed_once_for_their_lines(spark, monkeypatch):
    for name in ("join_lines", "join_lines_points"):
        want = entry.queries()[name](spark, SF)
        assert "rangepartitioning" in plan(want)
        with monkeypatch.context() as few:
            few.setattr(text_module, "_MIN_IDS", 1)
            few.setattr(text_module, "_RANGE_IDS", 2)
            found = entry.queries()[name](spark, SF)
        assert "rangepartitioning" not in plan(found)
        assert [r.value for r in found.collect()] == [r.value for r in want.collect()]


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_lines_of_many_ids_are_in_order(spark, monkeypatch, kind):
    monkeypatch.setattr(text_module, "_MIN_IDS", 1)
    monkeypatch.setattr(text_module, "_RANGE_IDS", 3)
    ids = spark.range(60).selectExpr(f"CAST(IF(id % 9 = 4, NULL, (id * 7 % 40 - 5) * 3) AS {kind}) AS id")
    if kind == "double":
        ids = ids.unionByName(spark.sql("SELECT double('NaN') AS id UNION ALL SELECT double('-Infinity')"))
    # ids without a list, lists of ids that nobody named, null ids, many parts of one id
    lists = ids.where("id IS NULL OR id > 0").unionByName(spark.sql(f"SELECT CAST(500 AS {kind}) AS id UNION ALL SELECT CAST(-500 AS {kind})"))
    parts = lists.distinct().selectExpr("id AS qid", "explode(array(2L, 0L, 1L)) AS part").selectExpr(
        "qid", "part", "IF(part = 1, array(), array(part, 9L)) AS tids"
    )
    for result in (parts, parts.where("part = 2").drop("part")):
        for asked in (ids, ids.where("id IS NULL"), ids.limit(0)):
            assert qd.to_lines(result, asked).collect() == qd.to_lines(result).collect()


def test_text_output_leaves_no_shuffle_files(spark):
    def shuffle_files():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffle_files()
    lines = entry.queries()["join_from_files"](spark, SF)
    for _ in range(50):  # they are deleted in the background
        if shuffle_files() <= before:
            break
        time.sleep(0.2)
    assert shuffle_files() <= before and lines.count() > 0
