"""Language identification with bit-sliced Bloom filters of character n-grams.

The filters of all languages share their hash positions and are stored slice by slice:
one machine word for each position, one bit in it for each language.  The words at the
positions of an n-gram, combined with AND, are the set of languages that contain it.  A
document adds up these sets; each language's count is corrected for the false positives
that its filter's fill makes likely, and the largest corrected share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.frames import slices
from quadrille.llm.words import mixed

GRAM, HASHES, BITS = 4, 2, 21
UNKNOWN = "und"
_SPREAD = 0x9E3779B97F4A7C15
_LETTERS: list[np.ndarray] = []


@dataclass
class Filters:
    """``masks``: for every 64 languages one array of ``2**bits`` words."""

    languages: list[str]
    masks: list[np.ndarray]
    fill: np.ndarray  # of each language's filter
    gram: int = GRAM
    hashes: int = HASHES
    bits: int = BITS


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the lower-cased texts, the text of each, and which texts have a letter.

    Runs of other characters count as one blank; an n-gram has a letter in its middle part.
    """
    joined = "\0".join(["", *(t.lower() for t in texts), ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    border = points == 0
    if border.sum() != len(texts) + 1:  # texts that hold NUL themselves
        joined = "\0".join(["", *(t.lower().replace("\0", " ") for t in texts), ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter, border = _letters()[points], points == 0
    keep = letter | border
    keep[1:] |= letter[:-1]  # the first of a run of other characters
    points, letter, border = np.where(letter, points, np.uint32(32))[keep], letter[keep], border[keep]
    owner = np.cumsum(border) - 1
    has = np.zeros(len(texts) + 1, bool)
    has[owner[letter]] = True
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has[:-1]
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(1_000_003) + points[k : k + n]
    middle = np.ones(n, bool)
    for k in range(1, size - 1):
        middle &= letter[k : k + n]
    middle &= owner[:n] == owner[size - 1 : size - 1 + n]
    return mixed(h[middle]), owner[:n][middle], has[:-1]


def positions(h: np.ndarray, hashes: int, bits: int) -> list[np.ndarray]:
    return [((h * np.uint64(_SPREAD * (2 * k + 1) % 2**64)) >> np.uint64(64 - bits)).astype(np.int64) for k in range(hashes)]


def fit(
    rows: DataFrame, text_col: str, lang_col: str, order: Column, rows_per_language: int = 2000,
    gram: int = GRAM, hashes: int = HASHES, bits: int = BITS, least_share: float = 0.002, ratio: float = 0.1,
) -> Filters:
    """Filters from labelled rows.

    About ``rows_per_language`` rows of each language are used, chosen by the hash
    ``order``; this documented bound is on the fit alone.  An n-gram enters a language's
    filter when it is in ``least_share`` of its sampled texts, in two at least if there
    are as many, and not ``ratio`` times rarer than in another language.  Rows without
    language or text teach nothing; without any row there is no language.
    """
    known = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), order.alias("h")
    )
    n = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(n, key=lambda k: (-n[k], k))
    empty = [np.zeros(1 << bits, np.uint64) for _ in range(-(-len(languages) // 64))]
    if not n:
        return Filters([], empty, np.zeros(0), gram, hashes, bits)
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, rows_per_language / n[k]))))
    chosen = known.where(F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, owner, _ = grams(batch.column("text").to_pylist(), gram)
                number = {k: i for i, k in enumerate(languages)}
                lang = np.array([number[k] for k in batch.column("lang").to_pylist()], np.int64)
                edge = np.flatnonzero(np.diff(owner, prepend=-1))
                found = [[np.zeros(0, np.uint64)] for _ in languages]
                for i, j in zip(edge, [*edge[1:], len(h)], strict=True):
                    found[lang[owner[i]]].append(np.unique(h[i:j]))
                for i, parts in enumerate(found):
                    once, times = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(once.view(np.int64)), pa.array(np.full(len(once), i, np.int32)), pa.array(times.astype(np.int64))],
                        ["gram", "lang", "n"],
                    )

    used = dict(chosen.groupBy("lang").count().collect())
    rate = F.create_map(*(F.lit(x) for i, k in enumerate(languages) for x in (i, float(used.get(k, 1)))))
    least = F.create_map(
        *(F.lit(x) for i, k in enumerate(languages) for x in (i, max(least_share * used.get(k, 0), 2.0 if used.get(k, 0) > 1 else 1.0)))
    )
    counted = (
        chosen.select("lang", "text").mapInArrow(count, "gram long, lang int, n long")
        .groupBy("gram", "lang").agg(F.sum("n").alias("n"))
        .withColumn("rate", F.col("n") / rate[F.col("lang")])
    )
    top = counted.groupBy("gram").agg(F.max("rate").alias("top"))
    kept = counted.join(top, "gram").where(
        (F.col("n") >= least[F.col("lang")]) & (F.col("rate") >= ratio * F.col("top"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, lang = batch.column("gram").to_numpy().view(np.uint64), batch.column("lang").to_numpy()
            for at in positions(h, hashes, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(lang // 64), pa.array(np.int64(1) << (lang % 64).astype(np.int64))],
                    ["at", "word", "mask"],
                )

    # 2**bits rows for each 64 languages at most
    words = kept.select("gram", "lang").mapInArrow(place, "at int, word int, mask long").groupBy("at", "word").agg(
        F.bit_or("mask").alias("mask")
    ).toArrow()
    at, word, mask = (words.column(c).to_numpy() for c in ("at", "word", "mask"))
    for w, m in enumerate(empty):
        m[at[word == w]] = mask[word == w].view(np.uint64)
    fill = np.array([np.count_nonzero(empty[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(languages))])
    return Filters(languages, [_narrow(m, len(languages)) for m in empty], fill / (1 << bits), gram, hashes, bits)


def _narrow(mask: np.ndarray, languages: int) -> np.ndarray:
    return mask.astype(np.uint8 if languages <= 8 else np.uint16 if languages <= 16 else np.uint64)


def shares(texts: list[str], f: Filters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corrected share of each text's n-grams for each language, number of n-grams, which texts have a letter."""
    h, owner, has = grams(texts, f.gram)
    n = np.bincount(owner, minlength=len(texts)).astype(float)
    wrong = f.fill**f.hashes
    out = np.zeros((len(texts), len(f.languages)))
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    at = positions(h, f.hashes, f.bits)
    for w, mask in enumerate(f.masks):
        found = mask[at[0]]
        for p in at[1:]:
            found = found & mask[p]
        for i in range(64 * w, min(64 * w + 64, len(f.languages))):
            if len(first):
                bit = ((found >> found.dtype.type(i % 64)) & found.dtype.type(1)).astype(np.int64)
                hits = np.add.reduceat(bit, first)
                total = n[owner[first]]
                out[owner[first], i] = (hits - total * wrong[i]) / np.maximum(total * (1 - wrong[i]), 1e-9)
    return np.clip(out, 0, 1), n, has


def identify(docs: DataFrame, f: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score``: one row for every row of ``docs``, from its whole text alone.

    ``und`` with score 0 if the text is null or has no letter, or no language was learned.
    Ties, and texts in which no n-gram is known, go to the language with most labelled rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(f))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        names = np.array([*own.languages, UNKNOWN], object)
        for whole in batches:
            for batch in slices(whole, "text"):
                share, _, has = shares([t or "" for t in batch.column("text").to_pylist()], own)
                best = np.argmax(share, 1) if len(own.languages) else np.zeros(len(has), np.int64)
                score = np.where(has, share.max(1, initial=0), 0.0)
                lang = names[np.where(has, best, len(own.languages))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no fit may see: crc32 of the id as text, modulo 3, is 1."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score``: fitted on the rows that aren't held out, applied to all."""
    seen = docs.where(F.coalesce(~held_out(id_col), F.lit(True)))
    f = fit(seen, text_col, lang_col, F.xxhash64(F.col(id_col).cast("string")))
    return identify(docs, f, id_col, text_col).select(
        id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, least_score: float = 0.2, short: int = 40) -> DataFrame:
    """The rows of ``docs`` in a learned language, columns unchanged; ids may repeat or be null.

    Without a letter a row goes; with a score under ``least_score`` it goes unless the text
    has fewer than ``short`` characters, too few to tell.
    """
    seen = docs.where(F.coalesce(~held_out(), F.lit(True)))
    f = fit(seen, "text", "lang", F.xxhash64(F.col("doc_id").cast("string")))
    shared = docs.sparkSession.sparkContext.broadcast(astuple(f))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                share, _, has = shares(texts, own)
                few = np.array([len(t) < short for t in texts], bool)
                keep = has & bool(own.languages) & (few | (share.max(1, initial=0) >= least_score))
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
