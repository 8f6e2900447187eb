"""Quality scores: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

Statistics of a text (never its label, language, source or id) are standardised and mapped to
cosines of random projections, whose inner products approximate a Gaussian kernel. A linear ridge
fit on them needs only sums of products, which each partition adds up for its rows; the sums have a
fixed size. Raw scores are calibrated on labelled documents the ridge did not see.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .training import labelled_sample

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[[32, 9, 10, 11, 12, 13]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[33, 46, 63]] = True
_COMMA = np.zeros(256, bool)
_COMMA[44] = True
_SYMBOLS = ~(_LETTERS | _DIGITS | _BLANKS | _ENDS | _COMMA)
_CLASSES = np.stack([_LETTERS, _UPPER, _DIGITS, _BLANKS, _ENDS, _COMMA, _SYMBOLS], 1).astype(float)
N_STATS = 16


def statistics(text: str) -> np.ndarray:
    """Sixteen statistics of a whole text; an empty one gives zeros."""
    raw = text.encode()
    if not raw:
        return np.zeros(N_STATS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = counts @ _CLASSES / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    p = counts[counts > 0] / len(raw)
    rows = [x for x in lines if x]
    pairs = set(zip(words, words[1:]))
    return np.array([
        *shares,
        counts.max() / len(raw),
        -(p * np.log2(p)).sum(),
        np.log1p(len(words)),
        (len(raw) - counts[32]) / n / 10,
        len(set(words)) / n,
        len(pairs) / max(1, len(words) - 1),
        np.log1p(n / max(1, len(rows))),
        len(set(rows)) / max(1, len(rows)),
        raw.count(b" | ") / n,
    ])


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, stats``; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py() or "") for t in batch.column(1)]
            flat = np.concatenate(stats) if stats else np.zeros(0)
            offsets = np.arange(0, len(flat) + 1, N_STATS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "stats"]
            )

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class Model:
    """Standardisation, random projections, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / self.omega.shape[1]) * np.cos(z @ self.omega + self.phase)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.steps, self.levels)


def _stats_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _sums(df: DataFrame, width: int, vectors) -> np.ndarray:
    """Sum over all rows of what ``vectors(batch)`` adds up per batch, one flat array of ``width``.

    Each partition sends its sum once, in pieces; pieces are added in Spark.
    """
    piece = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += vectors(batch)
        parts = [total[i : i + piece].tolist() for i in range(0, width, piece)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], names=["at", "part"]
        )

    parts = df.mapInArrow(run, "at int, part array<double>")
    cells = parts.select("at", F.posexplode("part").alias("i", "x")).groupBy("at", "i").agg(F.sum("x").alias("x"))
    out = np.zeros(width)
    rows = cells.toPandas()
    out[rows["at"].to_numpy() * piece + rows["i"].to_numpy()] = rows["x"].to_numpy()
    return out


def isotonic(raw: np.ndarray, y: np.ndarray, bins: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins of equal size; one prior case of each class in each pool."""
    order = np.argsort(raw, kind="stable")
    groups = np.array_split(order, min(bins, len(order)))
    pools: list[list[float]] = []
    for g in groups:
        pools.append([raw[g].mean(), float(y[g].sum()), float(len(g)), raw[g].mean(), raw[g].mean()])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            top = pools.pop()
            low = pools[-1]
            low[1] += top[1]
            low[2] += top[2]
            low[4] = top[4]
    steps, levels = [], []
    for _, ones, n, first, last in pools:
        level = (ones + 0.05) / (n + 0.1)
        steps += [first, last]
        levels += [level, level]
    return np.array(steps), np.maximum.accumulate(np.array(levels))


def fit(
    stats: DataFrame,
    labels: DataFrame,
    where: Column,
    most: int = 60_000,
    features: int = 256,
    ridge: float = 1e-3,
    width: float = 2.5,
    seed: int = 7,
    partitions: int = 16,
) -> Model:
    """Fit on at most about ``most`` labelled rows of ``(doc_id, stats)`` per class.

    Four fifths of them, by a hash of the id, go into the ridge, the rest into the calibration. Where
    labels of both classes are missing, every document gets the share of label 1 (one half without
    labels).
    """
    sample = cut(
        labelled_sample(stats, labels, "quality", where, {0: most, 1: most}, text="stats").withColumn(
            "part", F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5))
        ).repartition(partitions, "doc_id")
    )
    n = sample.count()
    mean, scale = np.zeros(N_STATS), np.ones(N_STATS)
    if n:
        moments = _sums(
            sample.select("text"), 2 * N_STATS, lambda b: np.r_[(s := _stats_of(b.column(0))).sum(0), (s**2).sum(0)]
        )
        mean = moments[:N_STATS] / n
        scale = np.sqrt(np.maximum(moments[N_STATS:] / n - mean**2, 1e-8))
    rng = np.random.default_rng(seed)
    omega, phase = rng.normal(size=(N_STATS, features)) / width, rng.uniform(0, 2 * np.pi, features)
    d = features + 1
    model = Model(mean, scale, omega, phase, np.zeros(d), np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def products(batch: pa.RecordBatch) -> np.ndarray:
        x, y = model.features(_stats_of(batch.column(0))), batch.column(1).to_numpy().astype(float)
        return np.concatenate([(x.T @ x).ravel(), x.T @ y])

    if n:
        sums = _sums(sample.filter("part > 0").select("text", "y"), d * d + d, products)
        gram, target = sums[: d * d].reshape(d, d), sums[d * d :]
        model.weights = np.linalg.solve(gram + ridge * np.eye(d) * max(1.0, gram[-1, -1] / features), target)
        held = sample.filter("part = 0").select("text", "y").toPandas()
        if len(held):
            raw = model.raw(np.stack(held["text"].to_numpy()))
            model.steps, model.levels = isotonic(raw, held["y"].to_numpy().astype(float))
        else:
            model.levels = np.full(2, sums[-1] / max(1.0, gram[-1, -1]))
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each row of ``(doc_id, stats)``, from 0 to 1, higher for label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_stats_of(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")
