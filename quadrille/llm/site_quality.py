"""Document quality by hierarchical empirical Bayes.

A document classifier gives each text its own evidence.  Sites add theirs: the outcomes
of all documents of a host, and of a path on it, make posteriors of a Beta-binomial model
in which a path is shrunk towards its host and a host towards the corpus.  How strongly is
estimated from the spread between groups that chance alone doesn't explain, so sites with
few documents say little.  A document's own outcome is left out of its site's evidence.
Groups are sums with map-side combination, whatever share of the rows one host has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.frames import slices
from quadrille.llm.language_masks import held_out
from quadrille.llm.words import shingles, text_bytes, words
from quadrille.plans.materialize import checkpointed

FEATURES = ("symbols", "bars", "shouts", "capitals", "digits", "repeated", "echoes", "length", "word_length")
_CLASS = np.zeros((256, 6))
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()!?|"], 0] = 1
_CLASS[ord("|"), 1] = 1
_CLASS[ord("!"), 2] = 1
_CLASS[65:91, 3] = 1
_CLASS[48:58, 4] = 1
_CLASS[33:, 5] = 1


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text: shares of signs, of repeated words and shingles, sizes."""
    raw, offsets = text_bytes(column)
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    out = np.zeros((len(size), len(FEATURES)))
    if not len(full):
        return out
    sums = np.zeros((len(size), 6))
    for k in range(6):
        sums[full, k] = np.add.reduceat(_CLASS[:, k][raw], offsets[:-1][full])
    out[:, :5] = sums[:, :5] / np.maximum(sums[:, 5:], 1)
    h, first = words(column)
    n = np.diff(first)
    if len(h):
        same = np.zeros(len(h))
        same[1:] = h[1:] == h[:-1]
        some = np.flatnonzero(n)
        same[first[some]] = 0
        out[some, 5] = np.add.reduceat(same, first[some]) / n[some]
    three, at = shingles(column, 3)
    for i in np.flatnonzero(np.diff(at) > 1):
        own = three[at[i] : at[i + 1]]
        out[i, 6] = 1 - len(np.unique(own)) / len(own)
    out[:, 7] = np.log1p(n)
    out[:, 8] = np.minimum(sums[:, 5] / np.maximum(n, 1), 50)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept on the raw columns, by Newton steps on standardised ones."""
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.hstack(((x - mean) / spread, np.ones((len(x), 1))))
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge * len(x) / 100 + ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / spread, float(w[-1] - (w[:-1] * mean / spread).sum())


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _strength(spread: float, rate: float, groups: int, rows: int) -> float:
    """Prior sample size: from the spread between groups beyond that of chance."""
    chance = rate * (1 - rate)
    between = spread - chance * groups / max(rows, 1)
    return float(np.clip(chance / between - 1, 1, 1e6)) if between > 1e-12 else 1e6


def score(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", fit_rows: int = 20_000, threshold: float = 0.5,
    row_col: str | None = None,
) -> DataFrame:
    """``id_col, own, host_rate, path_rate, quality, kept``: one row for every row of ``docs``.

    ``own`` is the classifier's probability, ``host_rate`` and ``path_rate`` the shrunken
    posteriors of the site without the document itself, ``quality`` all combined.  The
    classifier is fitted on about ``fit_rows`` labelled rows (a bound on the fit alone)
    that aren't held out; the sites' evidence is over all rows, the label where one may be
    used and the classifier's probability elsewhere.  Labels of 0 and 1 count, repeated
    ones by their mean; without both, ``own`` is one half.  A null host or path is a site
    of its own, a null text counts as empty.  Rows with the same id share its label, a null
    id has none; ``row_col``, a long that tells rows apart, is put first in the result.
    """
    names = ["id", "row", "host", "path", "held"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                f = features(batch.column("text"))
                flat = pa.array(f.ravel())
                lists = pa.ListArray.from_arrays(np.arange(len(f) + 1, dtype=np.int32) * len(FEATURES), flat)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists], [*names, "f"])

    source = docs.select(
        F.col(id_col).cast("long").alias("id"), (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"),
        host.cast("string").alias("host"), path.cast("string").alias("path"),
        F.coalesce(held_out(id_col), F.lit(True)).alias("held"), F.col(text_col).alias("text"),
    )
    measured = source.mapInArrow(run, "id long, row long, host string, path string, held boolean, f array<double>")
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.avg(F.col(label_col).cast("double")).alias("label")
    )
    rows = checkpointed(measured.join(known, "id", "left"))
    train = rows.where(~F.col("held") & F.col("label").isNotNull())
    n = train.count()
    chosen = train.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < min(1.0, fit_rows / max(n, 1)) * (1 << 20))
    sample = chosen.select("f", "label").toArrow()
    y = sample.column("label").to_numpy()
    if len(y) and y.min() < y.max():
        x = np.stack(sample.column("f").to_numpy())
        weights, base = fit_logistic(x, y)
        linear = sum((F.col("f")[i] * float(w) for i, w in enumerate(weights)), F.lit(base))
    else:
        linear = F.lit(0.0)
    own = 1 / (1 + F.exp(-F.least(F.greatest(linear, F.lit(-30.0)), F.lit(30.0))))
    scored = rows.select("id", "row", "host", "path", own.alias("own"), "held", "label").withColumn(
        "seen", F.when(~F.col("held") & F.col("label").isNotNull(), F.col("label")).otherwise(F.col("own"))
    )
    scored = checkpointed(scored.select("id", "row", "host", "path", "own", "seen"))
    paths = checkpointed(
        scored.groupBy("host", "path").agg(F.sum("seen").alias("path_sum"), F.count(F.lit(1)).alias("path_n"))
    )
    hosts = checkpointed(paths.groupBy("host").agg(F.sum("path_sum").alias("host_sum"), F.sum("path_n").alias("host_n")))
    total, count, n_hosts = hosts.agg(F.sum("host_sum"), F.sum("host_n"), F.count(F.lit(1))).first()
    rate = float(np.clip(total / count, 1e-6, 1 - 1e-6)) if count else 0.5
    spread = hosts.agg(F.sum(F.col("host_n") * (F.col("host_sum") / F.col("host_n") - rate) ** 2)).first()[0]
    strong = _strength((spread or 0) / max(count or 0, 1), rate, n_hosts, count or 0)
    joined = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host")))
    host_mean = (F.col("host_sum") + strong * rate) / (F.col("host_n") + strong)
    spread, n_paths = joined.agg(
        F.sum(F.col("path_n") * (F.col("path_sum") / F.col("path_n") - host_mean) ** 2), F.count(F.lit(1))
    ).first()
    path_strong = _strength((spread or 0) / max(count or 0, 1), rate, n_paths, count or 0)
    site = joined.select("p.host", "p.path", "path_sum", "path_n", "host_sum", "host_n").alias("s")
    d = scored.alias("d").join(
        site, F.col("d.host").eqNullSafe(F.col("s.host")) & F.col("d.path").eqNullSafe(F.col("s.path"))
    )
    host_rate = (F.col("host_sum") - F.col("seen") + strong * rate) / (F.col("host_n") - 1 + strong)
    d = d.select("id", "row", "own", "seen", "path_sum", "path_n", host_rate.alias("host_rate"))
    path_rate = (F.col("path_sum") - F.col("seen") + path_strong * F.col("host_rate")) / (F.col("path_n") - 1 + path_strong)
    d = d.select("id", "row", "own", "host_rate", path_rate.alias("path_rate"))
    both = _logit(F.col("own")) + _logit(F.col("path_rate")) - float(np.log(rate / (1 - rate)))
    quality = 1 / (1 + F.exp(-both))
    return d.select(
        *([F.col("row").alias(row_col)] if row_col else []), F.col("id").alias(id_col), "own", "host_rate", "path_rate", quality.alias("quality"),
        (quality >= threshold).alias("kept"),
    )
