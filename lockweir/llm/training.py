"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def fold(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id is in no fold."""
    return F.crc32(F.col(key).cast("string")) % n


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, where: Column, most: dict[int, int], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text, y`` for at most about ``most[y]`` labelled documents of each class.

    ``where`` picks the rows that may be learnt from. Each class is thinned by a hash of the id, so
    the same rows come out at every run. The ids taken are bounded by ``most``, hence broadcast; the
    texts are not shuffled. Null labels are left out; of repeated ids the greatest label counts.
    """
    known = (
        labels.filter(where & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect() if r["y"] in most}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(_PARTS))
    keep = F.lit(False)
    for y, n in counts.items():
        keep = keep | ((F.col("y") == y) & (draw < int(_PARTS * min(1.0, most[y] / n))))
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(known.filter(keep)), "doc_id"
    )
