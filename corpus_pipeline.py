"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

Toxic documents go, one document of each group of near-duplicates stays, documents that hold
benchmark items go, personal data gets surrogates, and what is left is encoded into pieces.

All stages but the last return the columns they were given. Documents are told apart by ``doc_id``:
rows with a null id are never dropped as duplicates, and repeated rows of an id that stays all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lockweir.llm import decontamination, pieces, simhash, surrogates, toxicity
from lockweir.llm.settings import bound_batches, piece_model, surrogate_key
from lockweir.session import cut
from lockweir.sources.derived import table

_OWN = "_lockweir_"


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose toxicity is at least 0.7, by a model fitted on their labels."""
    bound_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.with_toxicity(docs, model, score=f"{_OWN}score", spans=f"{_OWN}spans")
    return scored.filter(F.col(f"{_OWN}score") < 0.7).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of near copies (five words, 0.8)."""
    bound_batches(spark)
    found = simhash.near_copies(docs)
    gone = cut(found.filter("doc_id <> component_id").select(F.col("doc_id").alias(f"{_OWN}id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone[f"{_OWN}id"], "left_anti")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; ``n_chars`` follows."""
    replaced = surrogates.anonymise(docs, surrogate_key(spark), count=None)
    if "n_chars" not in docs.columns:
        return replaced
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids, decoded``: the texts as pieces, and what these decode to."""
    bound_batches(spark)
    vocabulary = pieces.Vocabulary.load(piece_model())
    decoded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return decoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "decoded")


STAGES = [
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("pii_surrogates", personal_data),
    ("sentencepiece", piece_ids),
]

#: No SQL: fitted models, XXH64, keyed draws and a model file; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
