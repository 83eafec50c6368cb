"""Exact and near copies, shards."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from quadrille.llm import frames, minmax_dedup
from quadrille.llm.balanced_shards import propagate, shard_documents
from quadrille.llm.content_sort import distinct_texts, exact_duplicates
from quadrille.llm.frames import components
from quadrille.llm.minmax_dedup import near_duplicates
from quadrille.llm.words import shingles

WORDS = [f"w{i}" for i in range(400)]


def family(seed=5, bases=6, copies=14):
    """Bases with copies at every strength of editing, so that similarities lie on both sides of the limit."""
    r, out = random.Random(seed), []
    for _ in range(bases):
        base = [r.choice(WORDS) for _ in range(r.randint(30, 120))]
        out.append(" ".join(base))
        for k in range(copies):
            w = list(base)
            for _ in range(k // 2):
                w[r.randrange(len(w))] = r.choice(WORDS)
            out.append(" ".join(w))
    return out


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


ODD = [None, "", " \n\t ", "one", "ONE", "one two three four", "one two three four", "É a b c d e", "é a b c d e",
       "a\x0bb\x0cc\rd e f", "a b c d e f", "long " * 20000, "long " * 20001]


@pytest.mark.parametrize("texts", [family() + ODD, family(8, 2, 40), ODD[:3], []])
def test_near_copies_equal_brute_force(docs, texts):
    got = {r[0]: tuple(r)[1:] for r in near_duplicates(docs(texts)).collect()}
    assert got == brute(texts)


def test_frequent_keys_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(frames, "_HOT", 3)
    monkeypatch.setattr(minmax_dedup, "_BLOCK", 4)
    texts = family(8, 2, 40) + family(3, 3, 6)
    assert {r[0]: tuple(r)[1:] for r in near_duplicates(docs(texts)).collect()} == brute(texts)


def test_spread_join(spark, monkeypatch):
    monkeypatch.setattr(frames, "_HOT", 10)
    many = spark.range(300).selectExpr("id as rep", "if(id % 3 = 0, -1, id % 50) as k")
    one = spark.range(-1, 20).selectExpr("id as k", "id * 2 as v")
    for how in ("inner", "left"):
        got = frames.spread_join(many, one, "k", "rep", how).select("k", "rep", "v")
        assert sorted(got.collect(), key=str) == sorted(many.join(one, "k", how).select("k", "rep", "v").collect(), key=str)


def test_stored_rows_stay_where_they_are(spark):
    rows = frames.stored_by(spark.range(1000).withColumn("text", F.lit("x")), "id")
    few = spark.range(100).groupBy((F.col("id") * 3).alias("id")).count().select("id")
    plan = rows.join(few, "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    stored = next(line for line in plan.splitlines() if "ExistingRDD" in line)
    assert "text" in stored and plan.count("Exchange hashpartitioning") == 1


def test_shingles_of_slices_agree():
    import pyarrow as pa

    texts = family(3, 2, 4) + ODD
    h, at = shingles(pa.array(texts))
    for i, t in enumerate(texts):
        own, _ = shingles(pa.array([None, t, "x y"]))
        assert set(h[at[i] : at[i + 1]]) | set(own[-1:]) == set(own)
        assert len(set(h[at[i] : at[i + 1]])) == len(shingle_set(t))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_copies(docs, keep):
    texts = ["same"] * 300 + ODD + ["same ", "Same", "x" * 100_000, "x" * 100_000 + "y"] + ["two"] * 2
    best = max if keep == "largest" else min
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    got = exact_duplicates(docs(texts, parts=5), keep=keep).collect()
    assert len(got) == len(texts)
    for r in got:
        own = groups[texts[r.doc_id] or ""]
        digest = hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
        assert tuple(r)[1:] == (best(own), len(own), best(own) == r.doc_id, digest)
    assert exact_duplicates(docs([])).collect() == []


def test_exact_copies_with_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, "b")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in exact_duplicates(rows).collect())
    assert got == [(0, 1, 3), (1, 1, 3), (1, 1, 3), (2, 2, 1)]
    assert [r.kept for r in exact_duplicates(rows).where("doc_id is null").collect()] == [False]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_distinct_texts_keeps_whole_rows(docs, keep):
    texts = ["same"] * 300 + ODD + ["same ", "x" * 100_000, "x" * 100_000 + "y", "x" * 100_000] + ["two"] * 2
    frame = docs(texts, parts=5).withColumn("null", F.lit(1)).withColumn("body", F.col("doc_id") * 2).withColumn("a b", F.lit("c"))
    best = max if keep == "largest" else min
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    want = sorted(tuple(r) for r in frame.collect() if best(groups[r.text or ""]) == r.doc_id)
    for df in (frame, frame.repartition(1)):
        out = distinct_texts(df, keep=keep)
        assert out.columns == frame.columns
        assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == want
    upper = distinct_texts(frame, normalise=F.upper, keep=keep).collect()
    assert len(upper) == len({(t or "").upper() for t in texts})
    assert distinct_texts(frame.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


def test_shards_are_even_and_keep_groups(docs):
    texts = [f"group {i % 40}" for i in range(200)] + [f"single {i}" for i in range(800)] + [None, ""]
    got = shard_documents(docs(texts)).collect()
    assert len(got) == len(texts)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    where = {}
    for r in got:
        where.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
        assert r["size"] == len((texts[r.doc_id] or "").encode()) + 1
    assert sum(len(where[f"group {i}"]) == 1 for i in range(40)) >= 36


def test_full_shards_still_bring_copies_together(docs):
    texts = [f"pair {i // 2}" for i in range(6000)]
    got = shard_documents(docs(texts)).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    where = {}
    for r in got:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(v) == 1 for v in where.values()) >= 0.9 * len(where)


def test_propagation_ends_and_reports_cut_links(spark):
    r = random.Random(9)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(900)]
    ids = spark.range(320)
    placed, cut = propagate(ids, spark.createDataFrame(links, "a long, b long"), shards=4)
    shard = {x.id: x.shard for x in placed.collect()}
    assert len(shard) == 320
    assert cut == sum(shard[a] != shard[b] for a, b in links if a != b) < 0.7 * len(links)
    assert max(Counter(shard.values()).values()) <= 110


def test_shards_of_one_huge_group_few_rows_and_none(docs):
    got = shard_documents(docs(["same"] * 400 + [str(i) for i in range(200)])).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert len(shard_documents(docs(["a", "a", None])).collect()) == 3
    assert shard_documents(docs([])).collect() == []


def test_stages_with_null_and_repeated_ids(spark, tmp_path):
    r = random.Random(4)
    texts = [" ".join(r.choice("ka ro mi te su lo pe".split()) + r.choice("ra no di".split()) for _ in range(80)) for _ in range(6)]
    rows = [(1, texts[0])] * 4 + [(None, texts[1])] * 2 + [(2, texts[1]), (None, texts[2]), (None, texts[2]), (3, texts[3]), (3, texts[4]), (9, texts[3])]
    frame = spark.createDataFrame([(i, t, "aa", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(77, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns
        got[name] = sorted(((x.doc_id, x.text) for x in out.collect()), key=key)
    assert got["language"] == got["quality"] == sorted(rows, key=key)
    one = [(1, texts[0]), (2, texts[1]), (None, texts[2]), (3, texts[4])]
    assert got["exact"] == sorted([*one, (9, texts[3])], key=key)
    assert got["near"] == sorted([*one, (3, texts[3])], key=key)
    clash = frame.withColumn("row", F.lit("x")).withColumn("_row", F.lit("y"))
    for stage in (corpus_pipeline.quality, corpus_pipeline.near):
        out = stage(spark, clash, str(tmp_path))
        assert out.columns == clash.columns and {(x.row, x["_row"]) for x in out.collect()} == {("x", "y")}
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((p.doc_id is None, p.doc_id or 0) for p in packed)) == [(False, 1), (False, 2), (False, 3), (False, 9), (True, 0)]
    end = {}
    for p in sorted(packed, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == end.get(p.sequence_id, 0) and p.length <= 2048
        end[p.sequence_id] = p.offset + p.length
