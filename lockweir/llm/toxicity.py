"""Toxicity by multiple-instance learning: sentences score, documents are labelled.

A sentence's chance of being toxic is a logistic function of the listed words it holds; a document's
is the noisy-or of its sentences. Only documents carry labels, so the words' weights are fitted
through the noisy-or. The words are those that labelled documents use in more contexts (the word
before them) when toxic than chance would have it; counting contexts instead of documents keeps
the words of one often-copied text out. The same sentence scores then locate the offending
sentences of any document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .training import labelled_sample

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
# A sentence without listed words is toxic with a chance of at most sigmoid(MOST_BIAS), so that the
# noisy-or of a very long clean text stays low.
MOST_BIAS = -11.0
_CONTEXTS_AT_ONCE = 100_000
SPAN = "struct<start:int,end:int,score:double>"


@dataclass
class Model:
    """Weights of listed words and the bias of a sentence."""

    weights: dict[str, float]
    bias: float

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Start, end and score of each sentence that holds a listed word; offsets in code points."""
        out = []
        for m in _SENTENCE.finditer(text):
            z = [self.weights[w] for w in set(_WORD.findall(m.group().lower())) if w in self.weights]
            if z:
                out.append((m.start(), m.end(), _sigmoid(self.bias + sum(z))))
        return out

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences, and the sentences that hold listed words."""
        found = self.sentences(text) if not self.weights.keys().isdisjoint(_WORD.findall(text.lower())) else []
        n = len(_SENTENCE.findall(text))
        clean = (n - len(found)) * np.log1p(-_sigmoid(self.bias))
        clean += sum(np.log1p(-min(p, 1 - 1e-12)) for _, _, p in found)
        return float(-np.expm1(clean)), found


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def context_counts(sample: DataFrame) -> DataFrame:
    """Per word, the distinct contexts it has in toxic and in other documents: ``word, pos, neg``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(seen):
            cols = list(zip(*seen)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32())],
                names=["word", "before", "y"],
            )

        for batch in batches:
            seen: set[tuple[str, str, int]] = set()
            for text, y in zip(batch.column(0), batch.column(1)):
                words = _WORD.findall((text.as_py() or "").lower())
                seen.update(zip(words, ["", *words], [y.as_py()] * len(words)))
                if len(seen) > _CONTEXTS_AT_ONCE:
                    yield told(seen)
                    seen = set()
            yield told(seen)

    pairs = sample.select("text", "y").mapInArrow(run, "word string, before string, y int")
    by_context = pairs.groupBy("word", F.xxhash64("before").alias("context"), "y").agg(F.lit(1).alias("one"))
    return by_context.groupBy("word").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("y") == 1, 0).otherwise(1)).alias("neg"),
    )


def telling_words(
    counts: DataFrame, max_words: int, least_contexts: int, least_gain: float, least_lift: float
) -> list[str]:
    """Words over-represented in toxic documents; at most ``max_words``.

    The odds of a toxic context must be at least ``least_lift`` times those of all words, and the
    log-likelihood ratio at least ``least_gain``.
    """
    totals = counts.agg(F.sum("pos").cast("double").alias("tp"), F.sum("neg").cast("double").alias("tn")).first()
    tp, tn = totals["tp"] or 0.0, totals["tn"] or 0.0
    if not tp or not tn:
        return []
    share = tp / (tp + tn)
    n = F.col("pos") + F.col("neg")
    part = lambda k, expected: F.when(k > 0, k * F.log(k / (n * expected))).otherwise(0.0)
    gain = 2 * (part(F.col("pos"), share) + part(F.col("neg"), 1 - share))
    kept = counts.filter((F.col("pos") >= least_contexts) & (F.col("pos") * tn >= F.col("neg") * (least_lift * tp)) & (gain >= least_gain))
    top = kept.select("word", gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(max_words)
    return [r["word"] for r in top.collect()]


def bags(sample: DataFrame, words: list[str]) -> DataFrame:
    """Per labelled document ``y``, its number of sentences, and the listed words of each sentence that has any."""
    number = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, found = [], []
            for text in batch.column(0):
                sentences = _SENTENCE.findall((text.as_py() or "").lower())
                hits = [sorted({number[w] for w in _WORD.findall(s) if w in number}) for s in sentences]
                ns.append(len(sentences))
                found.append([h for h in hits if h])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(ns, pa.int32()), pa.array(found, pa.list_(pa.list_(pa.int32())))],
                names=["y", "n", "hits"],
            )

    return sample.select("text", "y").mapInArrow(run, "y int, n int, hits array<array<int>>")


def fit_noisy_or(y: np.ndarray, n: np.ndarray, hits: list, n_words: int, steps: int = 400, decay: float = 1e-4):
    """Weights and bias by Adam on the noisy-or likelihood of document labels, both classes weighing the same."""
    owner = np.array([d for d, sentences in enumerate(hits) for _ in sentences], np.int64)
    sizes = [len(s) for sentences in hits for s in sentences]
    word = np.array([w for sentences in hits for s in sentences for w in s], np.int64)
    sent = np.repeat(np.arange(len(sizes)), sizes).astype(np.int64)
    bare = n - np.bincount(owner, minlength=len(y))
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    theta = np.r_[np.full(n_words, 2.0 - MOST_BIAS), MOST_BIAS]  # a listed word is toxic until clean texts hold it
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        z = theta[-1] + np.bincount(sent, weights=theta[word], minlength=len(sizes))
        p, p0 = _sigmoid(z), _sigmoid(theta[-1])
        clean = bare * np.log1p(-p0) + np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        toxic = np.maximum(-np.expm1(clean), 1e-12)
        pull = weight * np.where(y == 1, -(1 - toxic) / toxic, 1.0)
        by_sentence = pull[owner] * p
        grad = np.r_[
            np.bincount(word, weights=by_sentence[sent], minlength=n_words) + decay * theta[:-1] / max(1, n_words),
            by_sentence.sum() + (pull * bare).sum() * p0,
        ]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-12)
        theta[-1] = min(theta[-1], MOST_BIAS)
    return theta[:-1], float(theta[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    where: Column,
    most_toxic: int = 8_000,
    most_other: int = 24_000,
    max_words: int = 4_096,
    least_contexts: int = 4,
    least_gain: float = 12.0,
    least_lift: float = 6.0,
) -> Model:
    """Fit on at most about ``most_toxic`` and ``most_other`` labelled documents ``where`` allows.

    The sample bounds everything the driver sees: the word list (``max_words``) and each sampled
    document's listed words. Without documents of both classes no word is listed.
    """
    sample = labelled_sample(docs, labels, "toxic", where, {1: most_toxic, 0: most_other})
    words = telling_words(context_counts(sample), max_words, least_contexts, least_gain, least_lift)
    if not words:
        return Model({}, MOST_BIAS)
    rows = bags(sample, words).toPandas()
    hits = [[list(s) for s in doc] for doc in rows["hits"]]
    weights, bias = fit_noisy_or(rows["y"].to_numpy(), rows["n"].to_numpy(), hits, len(words))
    return Model({w: float(x) for w, x in zip(words, weights) if x > 0}, bias)


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", score: str = "score", spans: str = "offending", least: float = 0.5) -> DataFrame:
    """Add the score of each whole text and its offending sentences (score at least ``least``).

    Null and empty texts score 0 and have no sentences. All columns are kept; columns already named
    like the two new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in (score, spans)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        at = kept.index(text)
        for batch in batches:
            results = [model.score(t.as_py() or "") for t in batch.column(at)]
            found = [[dict(zip(("start", "end", "score"), s)) for s in f if s[2] >= least] for _, f in results]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in results], pa.float64()), pa.array(found, kind)],
                names=[*kept, score, spans],
            )

    return docs.select(*kept).mapInArrow(run, f"{schema}, `{score}` double, `{spans}` array<{SPAN}>")
