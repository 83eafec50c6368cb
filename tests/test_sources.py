"""Text in and out, bad rows, streams."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

import quadrille as qd
from quadrille.functions.shapes import keep_valid
from quadrille.streaming import stream_boxes, stream_points


def write(path, *lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_readers(spark, tmp_path):
    p = write(tmp_path / "p.txt", "1,2.5,3", "2,1e3, -4 ,extra", "3,0.5,1,,")
    assert rows(qd.read_points(spark, p)) == [(1, 2.5, 3.0), (2, 1000.0, -4.0), (3, 0.5, 1.0)]
    p = write(tmp_path / "s.txt", "car-7,1,2")
    assert rows(qd.read_points(spark, p, id_type="string")) == [("car-7", 1.0, 2.0)]
    p = write(tmp_path / "bare.txt", "1,2", "3,4")
    assert rows(qd.read_points(spark, p, with_id=False)) == [(1.0, 2.0), (3.0, 4.0)]
    p = write(tmp_path / "r.txt", "9,4,3,2,1")
    assert rows(qd.read_rects(spark, p)) == [(9, 4.0, 3.0, 2.0, 1.0)]
    p = write(tmp_path / "rb.txt", "4,3,2,1")
    assert rows(qd.read_rects(spark, p, with_id=False)) == [(4.0, 3.0, 2.0, 1.0)]
    p = write(tmp_path / "m.txt", "1,2,3", "2,0,0,5,5")
    assert rows(qd.read_boxes(spark, p)) == [(1, 2.0, 3.0, 2.0, 3.0, True), (2, 0.0, 0.0, 5.0, 5.0, False)]
    p = write(tmp_path / "w.txt", "400,12,100,5", "1,1,1,1")
    assert qd.read_window(spark, p) == (100.0, 5.0, 400.0, 12.0)


@pytest.mark.parametrize("line", ["1,2", "1,2,x", "x,2,3", "1,NaN,2", ""])
def test_bad_lines(spark, tmp_path, line):
    p = write(tmp_path / "p.txt", "1,2,3", line)
    with pytest.raises(PySparkException):
        qd.read_points(spark, p).collect()
    assert rows(qd.read_points(spark, p, on_bad="drop")) == [(1, 2.0, 3.0)]


def test_four_tokens_are_no_rectangle(spark, tmp_path):
    p = write(tmp_path / "m.txt", "1,2,3,4")
    with pytest.raises(PySparkException):
        qd.read_boxes(spark, p).collect()


def test_bad_coordinates_are_counted_or_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("inf"), 0.0), (None, 1.0)], "x double, y double")
    seen = Observation()
    assert keep_valid(df, ("x", "y"), observation=seen).count() == 1
    assert seen.get == {"bad_rows": 2, "rows": 3}
    with pytest.raises(PySparkException):
        keep_valid(df, ("x", "y"), on_bad="fail").collect()


def test_round_trip_and_line_formats(spark, tmp_path, points, rects):
    t = points([(10, 1, 1), (9, 0, 0), (3, 5, 5)])
    q = rects([(10, 0, 0, 1, 1), (2, 0, 0, 5, 5)])
    formats = {
        "lists": (qd.spatial_join(t, q, output="lists"), ["2,3,9,10", "10,9,10"]),
        "pairs": (qd.spatial_join(t, q), ["2,3", "2,9", "2,10", "10,9", "10,10"]),
        "counts": (qd.spatial_count(t, q), ["2,3", "10,2"]),
        "ids": (qd.range_query(t, (5, 5, 5, 5)), ["3"]),
        "hull": (qd.convex_hull(t), ["0.0,0.0", "5.0,5.0"]),
        "far": (qd.farthest_pair(t), ["0.0,0.0", "5.0,5.0"]),
        "near": (qd.closest_pair(t), ["0.0,0.0", "1.0,1.0"]),
        "union": (qd.rect_union(rects([(0, 0, 1, 1)])), ["0.0,0.0", "0.0,1.0", "1.0,0.0", "1.0,1.0"]),
    }
    for name, (result, want) in formats.items():
        out = str(tmp_path / name)
        qd.write_lines(result, out, single_file=True)
        assert [r.value for r in spark.read.text(out).collect()] == want, name
    with pytest.raises(PySparkException):
        qd.write_lines(formats["ids"][0], str(tmp_path / "ids"))


def test_streams_equal_batch(spark, tmp_path, rects):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.txt", "1,0,0", "2,1.5,1.5")
    write(folder / "b.txt", "3,2,2", "4,9,9")
    q = rects([(1, 0, 0, 2, 2), (2, 1, 1, 9, 9)])
    batch_points, batch_boxes = qd.read_points(spark, str(folder)), qd.read_boxes(spark, str(folder))
    streams = {
        "range": (lambda p: qd.range_query(p, (0, 0, 2, 2)), stream_points, batch_points, "append"),
        "join": (lambda p: qd.spatial_join(p, q), stream_points, batch_points, "append"),
        "boxes": (lambda p: qd.spatial_join(p, q), stream_boxes, batch_boxes, "append"),
        "count": (lambda p: qd.spatial_count(p, q), stream_points, batch_points, "complete"),
    }
    for name, (step, source, batch, mode) in streams.items():
        run = (
            step(source(spark, str(folder), 1)).writeStream.format("memory").queryName("s_" + name)
            .outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        run.awaitTermination()
        assert sorted(rows(spark.table("s_" + name))) == sorted(rows(step(batch))), name
