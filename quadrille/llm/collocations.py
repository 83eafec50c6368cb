"""Phrase collocations by best-first branch and bound.

A phrase's score is that of its worst cut: floor(1000 * a * n / (l * r)).  Cutting after
the first word, whose count is l, and with a <= r, no phrase that begins with that word can
score more than floor(1000 * n / l).  The frontier is the words that occur often enough,
and the rarest, whose bound is highest, are expanded first, in waves.  Within a wave
phrases grow to the right by a word at a time from prefixes that are frequent themselves.
A language is settled once the bound of every word not yet expanded lies below its last
surviving score; equal bounds are still expanded, as ties are ordered by other columns.

Growth counts hashes and only ever counts too much; one scan then counts the frequent
phrases exactly, as strings, and notes whether all occurrences have the same neighbour on
one side.  Such a phrase never occurs outside a longer candidate and is dropped.  Another
scan counts the parts of the survivors.  A scan gets its keys in slices of a fixed number
of hashes, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille.llm.frames import partitions, slices
from quadrille.llm.spans import Spans, byte_set, grams, spans
from quadrille.llm.words import mixed
from quadrille.plans.materialize import checkpointed

LEAST, LONGEST, TOP = 100, 5, 2000
#: Most hashes broadcast at a time (16 MB).
KEYS = 1 << 21
#: Shares of the open words' occurrences that the first waves expand; later waves take all.
WAVES = (1 / 8,)
#: Most languages whose totals are broadcast.
_LANGUAGES = 1 << 15
_HELD = 1 << 20  # partial counts held by a task
BLANKS, BREAKS = byte_set(0x20, 9), byte_set(*b".,;:!?", *range(0x0A, 0x0E))
_EXACT = "lang string, phrase string, size int, a long, left_lo long, left_hi long, right_lo long, right_hi long"


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _salted(s: Spans, lang: pa.Array) -> np.ndarray:
    """Word hashes that differ between languages."""
    salts = np.array([_salt(x) for x in lang.to_pylist()], np.uint64)
    return mixed(s.hashes ^ salts[s.value()])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Spans, np.ndarray]]:
    for whole in batches:
        for batch in slices(whole, "text"):
            s = spans(batch.column("text"), BLANKS, BREAKS)
            if len(s.begin):
                yield batch.column("lang"), s, _salted(s, batch.column("lang"))


class Members:
    """Membership in a set of hashes: a table of flags first, then a binary search."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.sort(keys.astype(np.int64).view(np.uint64))
        self.flags = np.zeros(1 << 22, bool)
        self.flags[self._slot(self.keys)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(42)).astype(np.int64)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self.flags[self._slot(h)] if len(self.keys) else np.zeros(len(h), bool)
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        out[at] = self.keys[place] == h[at]
        return out


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def _counts(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["h", "n"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, h, n`` of words, and with a null ``h`` of all words of a language."""
    for lang, s, h in _texts(batches):
        at, keys = grams(h, s.piece, 1)
        value = s.value()
        found, first, n = np.unique(keys, return_index=True, return_counts=True)
        names = np.array(lang.to_pylist(), object)
        per_text = np.bincount(value, minlength=len(lang))
        totals: dict[str, int] = {}
        for name, k in zip(names, per_text.tolist(), strict=True):
            totals[name] = totals.get(name, 0) + k
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*names[value[at[first]]], *totals], pa.string()),
                pa.concat_arrays([pa.array(found.view(np.int64)), pa.nulls(len(totals), pa.int64())]),
                pa.array(np.concatenate((n, np.array([*totals.values()], np.int64)))),
            ],
            ["lang", "h", "n"],
        )


def _extensions(members, prefix_size: int, sizes: range):
    """``h, n`` of the runs of ``sizes`` words whose first ``prefix_size`` words are a member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = members.value, []
        for _, s, h in _texts(batches):
            at, prefix = grams(h, s.piece, prefix_size)
            begin = at[known.has(prefix)]
            for size in sizes:
                held.append(np.unique(grams(h, s.piece, size, begin)[1], return_counts=True))
            if sum(len(p[0]) for p in held) > _HELD:
                held = [_added(held)]
                if len(held[0][0]) > _HELD // 2:
                    yield _counts(*held.pop())
        if held:
            yield _counts(*_added(held))

    return run


def _neighbours(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    v = values.view(np.int64)[order]
    return [np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)]


def _exactly(members, sizes: range):
    """``_EXACT`` rows of the member phrases: counts and the extreme neighbours, 0 for the end of a piece."""
    names = [c.split()[0] for c in _EXACT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = members.value
        for lang, s, h in _texts(batches):
            value, zero = s.value(), np.uint64(0)
            for size in sizes:
                at, keys = grams(h, s.piece, size)
                hit = known.has(keys)
                at, keys = at[hit], keys[hit]
                if not len(at):
                    continue
                left = np.where((at > 0) & (s.piece[at - 1] == s.piece[at]), h[at - 1], zero)
                after = np.minimum(at + size, len(h) - 1)
                right = np.where((at + size < len(h)) & (s.piece[after] == s.piece[at]), h[after], zero)
                order = np.argsort(keys, kind="stable")
                starts = np.flatnonzero(np.concatenate((np.ones(1, bool), np.diff(keys[order]) != 0)))
                lead = at[order[starts]]
                phrases = [b" ".join(s.text(i + k) for k in range(size)).decode("utf-8", "replace") for i in lead.tolist()]
                langs = lang.take(pa.array(value[lead]))
                columns = [
                    langs, pa.array(phrases, pa.string()), pa.array(np.full(len(lead), size, np.int32)),
                    pa.array(np.diff([*starts, len(at)]).astype(np.int64)),
                    *(pa.array(x) for x in _neighbours(left, order, starts) + _neighbours(right, order, starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _part_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each phrase, as the scans have it."""
    for batch in batches:
        for size in set(batch.column("size").to_pylist()):
            part = batch.filter(pa.compute.equal(batch.column("size"), size))
            s = spans(part.column("phrase"), BLANKS, BREAKS)
            _, keys = grams(_salted(s, part.column("lang")), s.piece, size)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["h"])


def _by_slices(
    source: DataFrame, keys: DataFrame, keys_at_once: int, scan: Callable, schema: str, finish: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``finish`` of a scan for every slice of ``keys(h)``; a slice is broadcast, whatever their number."""
    spark, n = source.sparkSession, keys.count()
    many = max(1, -(-n // keys_at_once))
    out = []
    for i in range(many):
        mine = keys.where(F.pmod(F.xxhash64("h"), F.lit(many)) == i).select("h").toArrow()
        sent = spark.sparkContext.broadcast(Members(mine.column("h").to_numpy()))
        out.append(checkpointed(finish(source.mapInArrow(scan(sent), schema))))
        sent.destroy()
    return reduce(DataFrame.unionByName, out)


def _grown(source: DataFrame, words: DataFrame, least: int, longest: int, keys_at_once: int) -> DataFrame | None:
    """Hashes of the frequent phrases that begin with one of ``words(h)``, and maybe a few more.

    The last two sizes grow in one scan: few prefixes are left there, so the shortcut costs
    less than another scan of the texts.
    """
    level, found = words, []
    for size in range(2, max(3, longest)):
        sizes = range(size, longest + 1) if size >= longest - 1 else range(size, size + 1)
        level = _by_slices(
            source, level, keys_at_once, lambda sent, size=size, sizes=sizes: _extensions(sent, size - 1, sizes),
            "h long, n long",
            lambda df: df.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h"),
        )
        if level.isEmpty():
            break
        found.append(level)
    return reduce(DataFrame.unionByName, found) if found else None


def _exact_counts(source: DataFrame, keys: DataFrame, sizes: range, keys_at_once: int) -> DataFrame:
    def finish(df: DataFrame) -> DataFrame:
        return df.groupBy("lang", "phrase", "size").agg(
            F.sum("a").alias("a"), *(F.min(c).alias(c) for c in ("left_lo", "right_lo")),
            *(F.max(c).alias(c) for c in ("left_hi", "right_hi")),
        )

    return _by_slices(source, keys, keys_at_once, lambda sent: _exactly(sent, sizes), _EXACT, finish)


def scored(cuts: DataFrame) -> DataFrame:
    """``cuts(a, n, l, r, ...)`` with ``score``: floor(1000 * a * n / (l * r)), exact beyond 64 bits."""
    wide = {c: f"cast({c} as decimal(19, 0))" for c in "anlr"}
    return cuts.withColumn(
        "score", F.expr(f"cast((cast(1000 as decimal(4, 0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']}) as bigint)")
    )


def _survivors(source: DataFrame, candidates: DataFrame, totals: DataFrame, least: int, longest: int, at_once: int) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the candidates that occur outside longer ones."""
    same = [(F.col(f"{side}_lo") == F.col(f"{side}_hi")) & (F.col(f"{side}_lo") != 0) for side in ("left", "right")]
    kept = _exact_counts(source, candidates, range(2, longest + 1), at_once).where(
        (F.col("a") >= least) & ((F.col("size") == longest) | ~(same[0] | same[1]))
    )
    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
        (F.col("size") - F.col("k")).alias("rest_size"),
    )
    cuts = checkpointed(cuts)
    parts = cuts.select("lang", F.col("head").alias("phrase"), F.col("k").alias("size")).unionByName(
        cuts.select("lang", F.col("rest").alias("phrase"), F.col("rest_size").alias("size"))
    ).distinct()
    keys = checkpointed(parts.mapInArrow(_part_keys, "h long").distinct())
    counts = _exact_counts(source, keys, range(1, longest), at_once).select("lang", "phrase", "a")
    both = (
        cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
    )
    worst = scored(both).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("cut")
    )
    return worst.select("lang", "phrase", "cut.*")


def _top(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with ``rank``; no task gets more than that of a language and cell."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64("phrase"), F.lit(partitions(rows.sparkSession))))
    inside = F.row_number().over(Window.partitionBy("lang", "_cell").orderBy(*order))
    few = dealt.withColumn("_place", inside).where(F.col("_place") <= top).drop("_cell", "_place")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", place).where(F.col("rank") <= top)


def _wave(pending: DataFrame, share: float) -> int | None:
    """Counts up to this one are expanded next: the rarest words, with ``share`` of all occurrences at least."""
    bucket = F.floor(F.log2("f") * 8)
    steps = pending.groupBy(bucket.alias("b")).agg(F.max("f").alias("most"), F.sum("f").alias("n")).orderBy("b").collect()
    total, done = sum(r["n"] for r in steps), 0
    for r in steps:
        done += r["n"]
        if done >= share * total:
            return r["most"]
    return None


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
    top: int = TOP, keys_at_once: int = KEYS, waves: tuple[float, ...] = WAVES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks (0x0A to
    0x0D) and into words at blanks and tabs.  Candidates are runs of 2 to ``longest`` words
    inside a piece that occur ``least`` times or more, overlaps included; ``n`` is the
    number of words of the language, ``a``, ``l`` and ``r`` count the phrase and its two
    parts at the cut with the lowest score, the first such.  A candidate that never occurs
    outside one longer candidate is dropped.  Order: score and ``a`` descending, phrase in
    byte order.

    A null text counts as empty, a null language is ``und``.  Repeated rows count each
    time; other columns are ignored, whatever their names.  Empty input: no rows.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    tally = source.mapInArrow(_word_counts, "lang string, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("f"))
    tally = checkpointed(tally.where((F.col("f") >= least) | F.col("h").isNull()))
    totals = tally.where("h is null").select("lang", F.col("f").alias("n"))
    if totals.count() <= _LANGUAGES:
        totals = F.broadcast(totals)
    words = tally.where("h is not null").join(totals, "lang").withColumn("bound", F.expr("cast(1000 as decimal(4, 0)) * n div f"))
    best = _nothing(spark)
    done, turn = 0, 0
    while True:
        floor = best.groupBy("lang").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("many"))
        floor = checkpointed(floor.where(F.col("many") >= top).select("lang", "floor"))
        if floor.count() <= _LANGUAGES:
            floor = F.broadcast(floor)
        pending = words.where(F.col("f") > done).join(floor, "lang", "left").where("floor is null or bound >= floor")
        pending = checkpointed(pending.select("h", "f"))
        most = _wave(pending, waves[turn] if turn < len(waves) else 1.0)
        if most is None:
            break
        found = _grown(source, pending.where(F.col("f") <= most).select("h"), least, longest, keys_at_once)
        if found is not None:
            fresh = _survivors(source, found, totals, least, longest, keys_at_once)
            best = checkpointed(_top(best.drop("rank").unionByName(fresh), top))
        done, turn = most, turn + 1
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long, rank long")
