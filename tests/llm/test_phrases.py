"""Collocations against counting everything."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quadrille.llm.collocations import collocations, scored

SCHEMA = "lang string, text string"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(_LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        if any(
            o == lang and len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (o, q), b in found.items()
        ):
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000 * a * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, k, p.decode(), -a, l, r, n[lang], -s)
        for lang, v in out.items() for k, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1)
    )


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("h", F.lit(1)).withColumn("n", F.lit("x"))
    got = collocations(df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def some_rows(seed, n=150):
    r = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "ärger", "é", "x1", "o'clock", "日本", "aa", "zz"]
    weights = [20, 12, 4, 4, 4, 2, 3, 2, 2, 2, 6, 1]
    rows = []
    for _ in range(n):
        w = r.choices(words, weights, k=r.randint(0, 25))
        text = "".join(x + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "! "]) for x in w)
        rows.append((r.choice(["en", "de", None, ""]), text + r.choice(["", "new york city hall", "aa aa aa aa"])))
    return rows


@pytest.mark.parametrize("top", [2000, 6])
def test_against_counting_everything(spark, top):
    rows = some_rows(1)
    assert found(spark, rows, least=6, top=top) == expected(rows, 6, top) != []


def test_slices_of_keys_and_waves_change_nothing(spark):
    rows = some_rows(2, 100)
    want = expected(rows, 5, 4)
    assert found(spark, rows, least=5, top=4, keys_at_once=3, waves=(0.5,)) == want
    assert found(spark, rows, least=5, top=4, waves=(0.01, 0.1, 0.3)) == want


def test_ties_at_the_last_place(spark):
    rows = [("en", f"{a} {b}") for a, b in ("ab", "cd", "ef", "gh") for _ in range(3)] + [("en", "i i i")] * 2
    assert found(spark, rows, least=2, top=3) == expected(rows, 2, 3)


def test_null_empty_repeated_and_long(spark):
    long = " ".join(["lorem ipsum dolor"] * 30000)
    rows = [(None, None), ("und", "a b"), (None, "A  B"), ("en", ""), ("en", "..."), ("en", " \t"), ("fr", long)]
    assert found(spark, rows, least=2, top=10) == expected(rows, 2, 10)
    assert found(spark, [], least=1) == []
    assert found(spark, [("en", None)], least=1) == []


def test_products_beyond_64_bits(spark):
    a, n, l, r = 3 * 10**13, 9 * 10**15, 4 * 10**13, 5 * 10**13
    row = scored(spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")).first()
    assert row["score"] == 1000 * a * n // (l * r)
