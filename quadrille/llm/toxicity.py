"""Toxicity by class-conditional Kneser-Ney models.

A word is a run of bytes with a blank at both ends.  Each class, toxic and ordinary, has
an interpolated Kneser-Ney model of the next byte after up to six bytes of the word, from
its labelled documents.  Both classes back off to the same model, that of all documents,
and this to continuation counts of three-byte runs, so that what a class has rarely seen
costs both the same.  A word's evidence is its log-likelihood under the toxic model less
that under the ordinary one.

Words whose evidence exceeds a margin make the lexicon; the evidence found in a document,
by the length of the text, and in all, goes through a logistic curve fitted on labelled
documents that the models have not seen.  All counts are of documents with a word, over
all documents; the tables that tasks get are sent in slices of a fixed number of entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.frames import slices
from quadrille.llm.spans import byte_set, spans
from quadrille.plans.materialize import checkpointed

#: Bytes of a run at most: six of context and the next one, so that a run packs into a long with its length.
ORDER = 7
DISCOUNT, STRENGTH, MARGIN = 0.75, 10.0, 2.0
#: Labelled ids up to this number are broadcast to the scan of the documents; beyond, documents are joined with them.
LABELS = 1 << 22
#: Most table entries broadcast at a time (32 MB).
ENTRIES = 1 << 21
#: Most labelled documents that fit the curve; one part in ``HELD`` of the training documents is kept for it.
FIT_ROWS, HELD = 20_000, 4
LONGEST_WORD = 48
BLANKS = byte_set(0x20, *range(9, 14))
_HELD_WORDS = 1 << 17
_COUNTS = "n long, toxic long, ordinary long"


def _texts(batches: Iterator[pa.RecordBatch]):
    for whole in batches:
        for batch in slices(whole, "text"):
            yield batch, spans(batch.column("text"), BLANKS, longest=LONGEST_WORD)


def _each_once(s) -> np.ndarray:
    """Indices of the first occurrence of every word in every value."""
    value = s.value()
    order = np.lexsort((s.hashes, value))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(value[order]) != 0) | (np.diff(s.hashes[order]) != 0)
    return order[new]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n, toxic, ordinary``: documents with a word, all and those of a class, added up as far as memory goes."""
    held: dict[bytes, np.ndarray] = {}

    def given() -> pa.RecordBatch:
        n = np.array([*held.values()], np.int64).reshape(-1, 3)
        out = [pa.array([*held], pa.binary()), *(pa.array(c) for c in n.T)]
        held.clear()
        return pa.RecordBatch.from_arrays(out, ["word", "n", "toxic", "ordinary"])

    for batch, s in _texts(batches):
        at = _each_once(s)
        if not len(at):
            continue
        kind = pa.compute.fill_null(batch.column("class"), -1).to_numpy()[s.value()[at]]
        _, lead, which = np.unique(s.hashes[at], return_index=True, return_inverse=True)
        n = np.stack([np.bincount(which, kind == k if k >= 0 else None, len(lead)) for k in (-1, 1, 0)], axis=1).astype(np.int64)
        for i, row in zip(at[lead].tolist(), n, strict=True):
            word = s.text(i)
            if word in held:
                held[word] = held[word] + row
            else:
                held[word] = row
        if len(held) > _HELD_WORDS:
            yield given()
    if held:
        yield given()


def runs(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every byte after a word's leading blank, the packed run that ends with it, and the number of its word.

    The low byte of a packed run is its length; then come its bytes, the last one lowest.
    """
    values = words.to_pylist()
    raw = np.frombuffer(b"".join(b" " + w + b" " for w in values), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in values], np.int64)
    start = np.repeat(np.cumsum(size) - size, size)
    place = np.arange(len(raw)) - start
    out = np.zeros(len(raw), np.uint64)
    for k in range(ORDER):
        has = np.flatnonzero(place >= k)
        out[has] |= raw[has - k] << np.uint64(8 * k + 8)
    out |= np.minimum(place + 1, ORDER).astype(np.uint64)
    keep = place > 0
    return out[keep].view(np.int64), np.repeat(np.arange(len(values)), size)[keep]


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, word = runs(batch.column("word"))
        found, which = np.unique(keys, return_inverse=True)
        sums = [np.bincount(which, batch.column(c).to_numpy()[word]).astype(np.int64) for c in ("n", "toxic", "ordinary")]
        yield pa.RecordBatch.from_arrays([pa.array(found), *map(pa.array, sums)], ["run", "n", "toxic", "ordinary"])


def _context(run: Column) -> Column:
    """A run without its last byte: the bytes before it, and its length."""
    return F.shiftrightunsigned(run, 16).bitwiseOR(F.shiftleft(run.bitwiseAND(F.lit(255)), 56))


def evidence(counts: DataFrame, discount: float = DISCOUNT, strength: float = STRENGTH) -> DataFrame:
    """``run, llr`` from ``counts(run, n, toxic, ordinary)``, for runs whose context a class has seen.

    ``llr`` is the logarithm of the toxic over the ordinary probability of the last byte.
    """
    # the shared last resort: in how many contexts a byte follows the two before it (2 ** 24 rows at most)
    three = F.shiftrightunsigned("run", 8).bitwiseAND(F.lit(0xFFFFFF))
    low = counts.groupBy(three.alias("three")).agg(F.count(F.lit(1)).alias("c"))
    pair = Window.partitionBy(F.shiftrightunsigned("three", 8))
    total, kinds = F.sum("c").over(pair), F.count(F.lit(1)).over(pair)
    low = low.select(
        "three", ((F.col("c") - F.lit(discount)) / total + F.lit(discount) * kinds / total / F.lit(256)).alias("low")
    )
    after = Window.partitionBy(_context(F.col("run")))

    def model(column: str, extra: float, back: Column) -> Column:
        """Interpolated probability; a context never seen gives what it backs off to."""
        seen, own = F.sum(column).over(after), F.greatest(F.col(column) - F.lit(discount), F.lit(0.0))
        kept = F.sum(F.greatest(F.col(column) - F.lit(discount), F.lit(0.0))).over(after)
        mass = (own + (seen - kept + F.lit(extra)) * back) / (seen + F.lit(extra))
        return F.when(seen > 0, mass).otherwise(back)

    with_low = counts.withColumn("three", three).join(low, "three")
    shared = with_low.withColumn("shared", model("n", 0.0, F.col("low")))
    both = shared.select(
        "run", (F.sum("toxic").over(after) + F.sum("ordinary").over(after)).alias("seen"),
        F.log(model("toxic", strength, F.col("shared")) / model("ordinary", strength, F.col("shared"))).alias("llr"),
    )
    return both.where("seen > 0").select("run", "llr")


class Weights:
    """Sums of weights by 64-bit key."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order].astype(np.float64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], 0.0)


def _by_slices(rows: DataFrame, weights: DataFrame, at_once: int, scan: Callable, schema: str) -> list[DataFrame]:
    """A scan of ``rows`` for every slice of ``weights(key, weight)``."""
    sc, many = rows.sparkSession.sparkContext, max(1, -(-weights.count() // at_once))
    out = []
    for i in range(many):
        mine = weights.where(F.pmod(F.xxhash64("key"), F.lit(many)) == i).select("key", "weight").toArrow()
        sent = sc.broadcast(Weights(*(mine.column(c).to_numpy() for c in ("key", "weight"))))
        out.append(checkpointed(rows.mapInArrow(scan(sent), schema)))
        sent.destroy()
    return out


def _word_evidence(sent):
    """``word, llr`` of the words that have any in this slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, word = runs(batch.column("word"))
            sums = np.bincount(word, known.of(keys), batch.num_rows).astype(float)
            keep = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").take(pa.array(keep)), pa.array(sums[keep])], ["word", "llr"]
            )

    return run


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("word").cast(pa.large_binary())
        s = spans(pa.Array.from_buffers(pa.large_string(), len(text), text.buffers(), offset=text.offset), BLANKS)
        yield pa.RecordBatch.from_arrays([pa.array(s.hashes.view(np.int64)), batch.column("llr")], ["key", "weight"])


def _found(sent):
    """``id, digest, found, bytes``: the evidence of the lexicon's words in each text, and the bytes of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch, s in _texts(batches):
            value, n = s.value(), batch.num_rows
            found = np.bincount(value, known.of(s.hashes.view(np.int64)), n).astype(float)
            size = np.bincount(value, s.end - s.begin + 1, n)
            # tells rows with the same id apart, whatever the order of the rows
            digest = np.zeros(n, np.uint64)
            place = np.arange(len(value)) - np.repeat(s.first[:-1], np.diff(s.first))
            np.add.at(digest, value, s.hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(digest.view(np.int64)), pa.array(found), pa.array(size.astype(float))],
                ["id", "digest", "found", "bytes"],
            )

    return run


def _whole(parts: list[DataFrame]) -> DataFrame:
    """Rows of all slices added up; a row that is there ``k`` times stays ``k`` times."""
    if len(parts) == 1:
        return parts[0]
    added = reduce(DataFrame.unionByName, parts).groupBy("id", "digest", "bytes").agg(
        F.sum("found").alias("found"), (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies")
    )
    return checkpointed(
        added.withColumn("found", F.col("found") / F.col("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")
    )


def _features(found: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.stack((np.ones(len(found)), 100 * found / np.maximum(size, 1), np.log1p(found)), axis=1)


def fitted(found: np.ndarray, size: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of the logistic curve (Newton steps, a little ridge); without both classes, only the share of toxic ones."""
    x, y = _features(found, size), toxic.astype(float)
    w = np.zeros(x.shape[1])
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.01
    w[0] = np.log(share / (1 - share))
    if len(np.unique(y)) < 2:
        return w
    ridge, used = np.diag([1e-6, 1e-2, 1e-2]), np.ones(x.shape[1], bool)
    while True:
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            z = x[:, used]
            slope = (z * (p * (1 - p))[:, None]).T @ z + ridge[used][:, used]
            step = np.linalg.solve(slope, z.T @ (y - p) - (ridge @ w)[used])
            w[used] += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        wrong = used & (w < 0) & (np.arange(len(w)) > 0)  # evidence never speaks for a document
        if not wrong.any():
            return w
        used &= ~wrong
        w[wrong] = 0


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
    threshold: float = 0.3, labels_at_once: int = LABELS, entries: int = ENTRIES, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``id_col, held_out, score, predicted``: one row for every row of ``docs``.

    ``labels`` has ``id_col`` and ``toxic_col``.  Only labels of documents with
    ``crc32(id as text) mod 4 <> 2`` are learned; the others are ``held_out``.  ``score`` is
    0 to 1, ``predicted`` is 1 from ``threshold`` on.  An id with labels that disagree, and
    a null label, teach nothing.  A null text counts as empty and scores by the curve's
    constant.  Rows with the same id are scored one by one; a null id has no label and is
    not held out.  Without labels of both classes the score is the share of toxic ones.
    Other columns are ignored.  Empty input: no rows.
    """
    key = F.col(id_col).cast("long")
    source = docs.select(key.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    crc = F.crc32(F.col("id").cast("string").cast("binary"))
    known = (
        labels.select(key.alias("id"), F.col(toxic_col).cast("int").alias("class"))
        .where("id is not null and class in (0, 1)").where(crc % 4 != 2)
        .groupBy("id").agg(F.min("class").alias("class"), F.max("class").alias("most")).where("class = most")
        .select("id", "class", (F.pmod(F.xxhash64("id"), F.lit(HELD)) == 0).alias("curve"))
    )
    known = checkpointed(known)
    taught = known.where("not curve").select("id", "class")
    if taught.count() <= labels_at_once:
        taught = F.broadcast(taught)
    words = checkpointed(
        source.join(taught, "id", "left").select("text", "class")
        .mapInArrow(_word_counts, f"word binary, {_COUNTS}").groupBy("word").agg(*_sums())
    )
    counts = words.mapInArrow(_run_counts, f"run long, {_COUNTS}").groupBy("run").agg(*_sums())
    weights = checkpointed(evidence(checkpointed(counts)).select(F.col("run").alias("key"), F.col("llr").alias("weight")))
    parts = _by_slices(words, weights, entries, _word_evidence, "word binary, llr double")
    of_word = parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, parts).groupBy("word").agg(F.sum("llr").alias("llr"))
    lexicon = checkpointed(of_word.where(F.col("llr") > MARGIN).mapInArrow(_word_keys, "key long, weight double"))
    scan = _by_slices(source, lexicon, entries, _found, "id long, digest long, found double, bytes double")
    rows = _whole(scan)
    # the curve's documents: a bounded number of them, the same ones in every run
    curve = known.where("curve")
    part = min(1.0, fit_rows / max(1, curve.count()))
    drawn = curve.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < int(part * (1 << 20)))
    fit = rows.join(drawn, "id").select("found", "bytes", "class").toArrow()
    w = fitted(*(fit.column(c).to_numpy() for c in ("found", "bytes", "class")))
    line = (
        F.lit(float(w[0])) + F.lit(float(100 * w[1])) * F.col("found") / F.greatest(F.col("bytes"), F.lit(1.0))
        + F.lit(float(w[2])) * F.log1p("found")
    )
    out = rows.select(
        F.col("id"), F.coalesce(crc % 4 == 2, F.lit(False)).alias("held_out"), (1 / (1 + F.exp(-line))).alias("score")
    )
    return out.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "toxic", "ordinary")]
