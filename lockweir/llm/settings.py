"""What a deployment sets: the secret of the surrogates, the size of Arrow batches, the files of public tokenizers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def surrogate_key(spark: SparkSession) -> str:
    """The secret of the job; the tables here are public, so an unset one has a stated default."""
    return spark.conf.get("lockweir.surrogate.key", "lockweir public test key")


def bound_batches(spark: SparkSession) -> None:
    """Bound what goes to a Python worker at a time by bytes: ten thousand whole texts can be of any size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("lockweir.arrow.batch.bytes", "4m"))


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokenizer() -> str:
    return _public("byte_bpe_50k.json")


def piece_model() -> str:
    return _public("piece_bpe_32k.model")
