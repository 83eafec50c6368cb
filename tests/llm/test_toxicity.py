"""Toxicity: the models against a plain form, held-out labels, odd input."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quadrille.llm import toxicity as tx
from quadrille.llm.queries import toxic_documents

DOCS, LABELS = "doc_id long, text string, label string", "doc_id long, quality int, toxic int"


def plain_evidence(words, discount=tx.DISCOUNT, strength=tx.STRENGTH):
    """``words``: {word: (n, toxic, ordinary)}; the same models with dictionaries."""
    c = defaultdict(lambda: [0, 0, 0])
    for word, n in words.items():
        b = b" " + word.encode() + b" "
        for i in range(1, len(b)):
            for k in range(3):
                c[b[max(0, i - 6) : i + 1]][k] += n[k]
    low = Counter((g[-3:-1], g[-1], len(g) == 2) for g in c)
    out = {}
    for g, n in c.items():
        same = [v for o, v in c.items() if o[:-1] == g[:-1]]
        around = [v for (pair, _, short), v in low.items() if (pair, short) == (g[-3:-1], len(g) == 2)]
        p = (low[g[-3:-1], g[-1], len(g) == 2] - discount) / sum(around) + discount * len(around) / sum(around) / 256
        models = []
        for k, extra in ((0, 0.0), (1, strength), (2, strength)):
            back, seen = (p if k == 0 else models[0]), sum(v[k] for v in same)
            kept = sum(max(v[k] - discount, 0) for v in same)
            models.append((max(n[k] - discount, 0) + (seen - kept + extra) * back) / (seen + extra) if seen else back)
        if sum(v[1] + v[2] for v in same):
            out[g] = math.log(models[1] / models[2])
    return out


def packed(g):
    return sum(x << (8 * k + 8) for k, x in enumerate(reversed(g))) + len(g)


def test_evidence_is_that_of_the_plain_models(spark):
    r = random.Random(3)
    words = {"".join(r.choices("abé", k=r.randint(1, 9))): (r.randint(3, 9), r.randint(0, 2), r.randint(0, 1)) for _ in range(60)}
    rows = [(w.encode(), *n) for w, n in words.items()]
    df = spark.createDataFrame(rows, f"word binary, {tx._COUNTS}").repartition(3)
    counts = df.mapInArrow(tx._run_counts, f"run long, {tx._COUNTS}").groupBy("run").agg(*tx._sums())
    got = {row["run"] % 2**64: row["llr"] for row in tx.evidence(counts).collect()}
    want = {packed(g): v for g, v in plain_evidence(words).items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_runs_are_packed_bytes():
    keys, word = tx.runs(pa.array([b"ab", b"abcdefghi"]))
    assert word.tolist() == [0] * 3 + [1] * 10
    assert keys[:3].view(np.uint64).tolist() == [packed(b" a"), packed(b" ab"), packed(b" ab ")]
    assert keys[12:13].view(np.uint64).tolist() == [packed(b"defghi ")]


def held(i, modulus=4, rest=2):
    return zlib.crc32(str(i).encode()) % modulus == rest


def test_held_out_labels_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in toxic_documents(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    asked = [i for i in labels if held(i) and i in got]
    toxic = [got[i]["score"] for i in asked if labels[i]]
    clean = [got[i]["score"] for i in asked if not labels[i]]
    better = np.mean([[(a > b) + 0.5 * (a == b) for b in clean] for a in toxic])
    assert len(toxic) >= 5 and better > 0.85
    assert np.mean(np.array(clean) >= 0.3) < 0.1


def some_documents(seed, n=400):
    r = random.Random(seed)
    calm, rude = ["the", "house", "is", "green", "and", "quiet", "today"], ["wretch", "wretched", "oaf"]
    docs, labels = [], []
    for i in range(n):
        y = i % 4 == 0
        w = r.choices(calm, k=r.randint(10, 60)) + (r.choices(rude, k=3) if y else [])
        r.shuffle(w)
        docs.append((i, " ".join(w), "odd"))
        labels.append((i, 1, int(y)))
    return docs, labels


def scored(spark, docs, labels, **options):
    df = spark.createDataFrame(docs, DOCS).repartition(3).withColumn("found", F.lit(0)).withColumn("class", F.lit("x"))
    return tx.score(df, spark.createDataFrame(labels, LABELS), **options).collect()


def test_new_words_of_a_toxic_stem(spark):
    docs, labels = some_documents(5)
    got = {r["doc_id"]: r for r in scored(spark, docs + [(9001, "the wretchedly quiet house", ""), (9002, "the quiet houses", "")], labels)}
    assert got[9001]["predicted"] == 1 and got[9002]["predicted"] == 0
    wrong = [i for i, _, y in labels if held(i) and got[i]["predicted"] != y]
    assert len(wrong) <= 2


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = some_documents(6, 200)
    turned = [(i, q, 1 - y if held(i) else y) for i, q, y in labels]
    a, b = (sorted((r["doc_id"], r["score"]) for r in scored(spark, docs, x)) for x in (labels, turned))
    assert a == b


def test_slices_and_joined_labels_give_the_same(spark):
    docs, labels = some_documents(7, 200)
    docs += docs[:5] + [(None, "the oaf", "")] * 2
    want = sorted((r["doc_id"] or -1, r["score"]) for r in scored(spark, docs, labels))
    got = sorted((r["doc_id"] or -1, r["score"]) for r in scored(spark, docs, labels, entries=40, labels_at_once=0))
    assert [x[0] for x in got] == [x[0] for x in want] and len(got) == 207
    assert all(abs(a[1] - b[1]) < 1e-9 for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(None, 1, 1), (1, None, None)]])
def test_odd_rows(spark, labels):
    long = "word" * 100_000
    docs = [(1, None, None), (2, "", ""), (None, "a b", ""), (3, " \n\t", ""), (3, long, ""), (3, long, ""), (4, "日本語" * 99, "")]
    got = scored(spark, docs, labels)
    assert len(got) == 7 and all(0 < r["score"] < 1 for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert scored(spark, [], labels) == []


def test_labels_that_disagree_teach_nothing(spark):
    docs, labels = some_documents(8, 200)
    more = labels + [(9005, 1, 1), (9005, 1, 0)]
    a = sorted((r["doc_id"], r["score"]) for r in scored(spark, docs + [(9005, "the oaf", "")], labels))
    b = sorted((r["doc_id"], r["score"]) for r in scored(spark, docs + [(9005, "the oaf", "")], more))
    assert a == b
