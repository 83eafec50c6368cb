"""Hard negatives against a plain loop over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, every=5, positives=5, negatives=10):
    used = [
        (i, [math.floor(256 * x) for x in v], y, k)
        for k, (i, v, y) in enumerate(rows)
        if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a in used:
        if a[0] % every:
            continue
        scored = [(-sum(p * q for p, q in zip(a[1], b[1], strict=True)), b[0], b[2] == a[2])
                  for b in used if b[3] != a[3] and len(b[1]) == len(a[1])]
        for ps, pid, same in sorted(x for x in scored if x[2])[:positives]:
            fit = sorted(x for x in scored if not x[2] and 30 * -ps <= 100 * -x[0] <= 90 * -ps)
            out += [(a[0], pid, r, x[1], -ps, -x[0]) for r, x in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, parts=3, every=5, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("row", F.lit("x")).withColumn("asks", F.lit(1))
    return sorted(map(tuple, hn.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()))


def some_rows(seed, n=160, labels=3, dims=6):
    r = random.Random(seed)
    rows = [(i, [r.choice((-1, 1)) * r.randint(0, 8) / 16 for _ in range(dims)], r.randrange(labels)) for i in range(n)]
    return [(i, v if r.random() < 0.7 else rows[0][1], y) for i, v, y in rows]  # a hot vector: many ties


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = some_rows(seed)
    assert mined(spark, rows) == expected(rows) != []


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 7)
    rows = some_rows(3)
    assert mined(spark, rows, row_block=31) == expected(rows)


def test_nulls_lengths_and_empty(spark):
    bad = [(None, [0.5] * 6, 1), (5, None, 1), (10, [None] * 6, 0), (15, [math.nan] * 6, 0), (20, [math.inf] * 6, 1),
           (25, [0.5] * 6, None), (30, [], 1), (35, [], 0), (40, [0.5, 0.25], 1), (45, [0.5, 0.25], 1),
           (46, [0.25, 0.25], 0), (50, [0.0] * 6, 2)]
    rows = bad + [(i + 100, v, y) for i, v, y in some_rows(4, 60)]
    assert mined(spark, rows) == expected(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1)]) == []


def test_repeated_ids_are_separate_rows(spark):
    rows = some_rows(5, 40)
    rows += rows[:10]
    assert mined(spark, rows) == expected(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**19, 1.0], 0), (1, [2.0**19, 3.0], 0), (2, [2.0**18, 5.0], 1), (3, [2.0**18 - 1, 7.0], 1)]
    got = mined(spark, rows)
    assert got == expected(rows) and len(got) == 2
    assert got[0][4] == 2**54 + 768 * 256 > 2**53


def test_too_large_scores_fail():
    with pytest.raises(OverflowError):
        hn.products(np.array([[2.0**33]]), np.array([[2.0**33]]))


def test_packed_keys_sort_like_tuples():
    r = random.Random(6)
    edge = [-(2**63), -5, -1, 0, 1, 7, 2**63 - 1]
    rows = [(r.choice(edge), r.choice(edge), r.choice((0, 1)), r.choice(edge), r.choice(edge)) for _ in range(300)]
    keys = [hn.packed_keys(*(np.array([x]) for x in (a, s)), k, np.array([i]), np.array([w]))[0] for a, s, k, i, w in rows]
    by_key = [x for _, x in sorted(zip(keys, rows, strict=True), key=lambda p: p[0])]
    assert [(a, -s, k, i, w) for a, s, k, i, w in by_key] == sorted((a, -s, k, i, w) for a, s, k, i, w in rows)
