"""Detection of personal data: fast mode, tagger spans, merging, summaries."""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.arrays import let, prefix
from ..functions.spans import DETECTORS, SPAN_ARRAY, Detector, pattern_spans
from ..sources.dims import listed
from .once import once


FEW_SPANS = 16  # of so few, copying what is kept at each step costs less than to find clusters


def detect_fast(
    text: Column | str,
    types: Iterable[str] | None = None,
    detectors: list[Detector] = DETECTORS,
) -> Column:
    """Spans of all pattern types, in type order; spans of different types may overlap."""
    text = F.col(text) if isinstance(text, str) else text
    wanted = [d for d in detectors if types is None or d.type in set(types)]
    parts = [pattern_spans(text, d.pattern, d.type, d.valid, d.hint) for d in wanted]
    # One pattern never yields a position twice, and types differ: there is nothing to dedupe.
    return F.concat(*parts) if parts else F.array().cast(SPAN_ARRAY)


def with_entities(
    df: DataFrame, text: str = "text", name: str = "entities", types: Iterable[str] | None = None
) -> DataFrame:
    return once(df, **{name: detect_fast(F.col(text), types)})


def explode_entities(df: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """One row per span."""
    return df.select(key, F.explode_outer(entities).alias("e")).filter(F.col("e").isNotNull()).select(
        key,
        F.col("e.type").alias("type"),
        F.col("e.text").alias("entity"),
        F.col("e.start").alias("span_start"),
        F.col("e.end").alias("span_end"),
        F.col("e.confidence").alias("confidence"),
    )


def guess_lang(text: Column | str, strict: bool = False) -> Column:
    """``tr`` if any listed letter occurs, else ``en``; ``strict`` tests only Turkish-only letters."""
    text = F.col(text) if isinstance(text, str) else text
    letters = config.TURKISH_LETTERS_STRICT if strict else config.TURKISH_LETTERS
    return F.when(text.rlike(f"[{letters}]"), "tr").otherwise("en")


def map_ner(spans: DataFrame, labels=config.NER_LABELS) -> DataFrame:
    """Tagger labels to entity types and confidences; other labels are dropped."""
    dim = listed(spans.sparkSession, list(labels), "label string, type string, confidence double")
    return spans.join(dim, "label")


def suppress(ner: DataFrame, regex: DataFrame, key: str) -> DataFrame:
    """Drop tagger spans that start or end inside a pattern span of the same text.

    The pattern spans of a text are gathered first, so the join meets one row per text and
    emits no pairs.
    """
    ranges = regex.groupBy(key).agg(
        F.collect_set(F.struct(F.col("span_start").alias("s"), F.col("span_end").alias("e"))).alias("_ranges")
    )
    a, b = F.col("span_start"), F.col("span_end")
    hit = F.exists(
        "_ranges", lambda r: ((r["s"] <= a) & (a < r["e"])) | ((r["s"] < b) & (b <= r["e"]))
    )
    return (
        ner.join(ranges, key, "left")
        .filter(F.col("_ranges").isNull() | ~hit)
        .select(*ner.columns)
    )


def suppress_arrays(ner: Column, regex: Column) -> Column:
    """The same on two span arrays of one row."""
    return F.filter(
        ner,
        lambda n: ~F.exists(
            regex,
            lambda r: ((r["start"] <= n["start"]) & (n["start"] < r["end"]))
            | ((r["start"] < n["end"]) & (n["end"] <= r["end"])),
        ),
    )


def merge_spans(entities: Column | str) -> Column:
    """Overlaps resolved: stable order by start; the last kept span yields only to a more confident one.

    Only spans that overlap others are folded: the sorted spans fall into clusters where a span
    starts at or after the end of all before it. A few spans are folded as they are.
    """
    entities = F.col(entities) if isinstance(entities, str) else entities
    ordered = F.transform(
        F.array_sort(
            F.transform(entities, lambda e, i: F.struct(e["start"].alias("s"), i.alias("i"), e.alias("e")))
        ),
        lambda x: x["e"],
    )

    def step(kept: Column, span: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        return (
            F.when(last.isNull() | (span["start"] >= last["end"]), F.concat(kept, F.array(span)))
            .when(
                span["confidence"] > last["confidence"],
                F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(span)),
            )
            .otherwise(kept)
        )

    def clusters(spans: Column, reach: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.size(spans) - 1),
            lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.coalesce(F.get(reach, i - 1), F.lit(0))),
        )
        cut = lambda b: F.transform(
            b, lambda at, k: F.slice(spans, at + 1, F.coalesce(F.get(b, k + 1), F.size(spans)) - at)
        )
        return let(begins, cut)

    fold = lambda c: F.when(F.size(c) == 1, c).otherwise(F.aggregate(c, F.array().cast(SPAN_ARRAY), step))

    def resolve(spans: Column) -> Column:
        reach = prefix(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        return F.flatten(F.transform(let(reach, lambda r: clusters(spans, r)), fold))

    few = lambda spans: F.aggregate(spans, F.array().cast(SPAN_ARRAY), step)
    return F.when(
        F.size(entities) > 1, let(ordered, lambda spans: F.when(F.size(spans) <= FEW_SPANS, few(spans)).otherwise(resolve(spans)))
    ).otherwise(entities)


def detect_detailed(df: DataFrame, ner: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Pattern spans plus mapped tagger spans ``(key, label, entity, span_start, span_end)``, merged."""
    mapped = map_ner(ner).groupBy(key).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("span_start").alias("start"), F.col("span_end").alias("end"), "type",
                    F.col("entity").alias("text"), "confidence",
                )
            )
        ).alias("_ner")
    )
    tagged = F.coalesce(
        F.transform(
            "_ner",
            lambda n: F.struct(
                n["type"].alias("type"), n["text"].alias("text"), n["start"].alias("start"),
                n["end"].alias("end"), n["confidence"].alias("confidence"),
            ),
        ),
        F.array().cast(SPAN_ARRAY),
    )
    return (
        with_entities(df, text, "_regex")
        .join(mapped, key, "left")
        .withColumn("entities", merge_spans(F.concat("_regex", suppress_arrays(tagged, F.col("_regex")))))
        .drop("_regex", "_ner")
    )


def count_type(entities: Column | str, entity_type: str) -> Column:
    return F.size(F.filter(entities, lambda e: e["type"] == entity_type))


def detect_summary(df: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """Per row: whether anything was found, how many, and how many of each pattern type."""
    e = F.col(entities)
    return df.select(
        key,
        (F.size(e) > 0).alias("pii_detected"),
        F.size(e).alias("entity_count"),
        *[
            count_type(e, t).alias(f"n_{t.lower()}")
            for t in config.REGEX_TYPES
        ],
    )


_WORD = r"[\w'-]+"
LISTED_WORDS = 20_000


def tokens_with_offsets(df: DataFrame, key: str, text: str = "text", only: frozenset[str] | None = None) -> DataFrame:
    """One row per word (of ``only``, if given) with its offsets, found batch-wise in one pass over each text."""
    import pyarrow as pa

    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        import re

        word = re.compile(_WORD)
        for batch in batches:
            keys, rows, words, starts, ends = batch.column(0), [], [], [], []
            for row, body in enumerate(batch.column(1).to_pylist()):
                for m in word.finditer(body or ""):
                    if only is not None and m.group() not in only:
                        continue
                    rows.append(row)
                    words.append(m.group())
                    starts.append(m.start())
                    ends.append(m.end())
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(rows, pa.int64())), pa.array(words, pa.string()),
                 pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                names=[key, "entity", "span_start", "span_end"],
            )

    return df.select(key, text).mapInArrow(
        run, f"`{key}` {key_type}, entity string, span_start int, span_end int"
    )


def dictionary_tagger(gazetteer: DataFrame) -> Callable[[DataFrame, str, str], DataFrame]:
    """A tagger that looks words up in a table ``(word, label)``.

    A list of at most ``LISTED_WORDS`` words goes along to the tasks, so that other words never leave
    them; beyond that every word is joined.
    """

    def run(df: DataFrame, key: str, text: str) -> DataFrame:
        listed = gazetteer.select(F.substring("word", 1, 200)).distinct().limit(LISTED_WORDS + 1).collect()
        short = len(listed) <= LISTED_WORDS and all(len(r[0] or "") < 200 for r in listed)
        words = tokens_with_offsets(df, key, text, frozenset(r[0] for r in listed) if short else None)
        return words.join(
            gazetteer.select(F.col("word").alias("entity"), "label").distinct(), "entity"
        ).select(key, "label", "entity", "span_start", "span_end")

    return run


def batch_tagger(load_model: Callable[[str], Callable]) -> Callable[[DataFrame, str, str], DataFrame]:
    """A tagger around a model: ``load_model(lang)`` returns ``texts -> [[(label, start, end)]]``.

    A model is loaded once per language and Python worker, at its first text.
    """

    def run(df: DataFrame, key: str, text: str) -> DataFrame:
        key_type = df.schema[key].dataType.simpleString()

        def tag_batches(batches):
            import pandas as pd

            models: dict[str, Callable] = {}
            for batch in batches:
                rows = []
                for lang, part in batch.groupby("lang"):
                    if lang not in models:
                        models[lang] = load_model(lang)
                    texts = part["text"].tolist()
                    for k, t, spans in zip(part["k"], texts, models[lang](texts)):
                        rows += [(k, label, t[a:b], a, b) for label, a, b in spans]
                yield pd.DataFrame(rows, columns=[key, "label", "entity", "span_start", "span_end"])

        return df.select(
            F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"), guess_lang(text).alias("lang")
        ).mapInPandas(
            tag_batches, f"`{key}` {key_type}, label string, entity string, span_start int, span_end int"
        )

    return run


def tag(df: DataFrame, tagger: Callable[[DataFrame, str, str], DataFrame], key: str, text: str = "text") -> DataFrame:
    return tagger(df, key, text)
