"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A shard file is a run of records: length (8 bytes, little-endian), masked CRC-32C of the length,
payload, masked CRC-32C of the payload; the framing that record readers of training frameworks
know. A payload is the document id (8 bytes) and the ids, each in 2 or 4 bytes as the vocabulary
needs. Beside each shard, an index file holds doc id, offset, record length and number of ids as
four long columns (Parquet), so that a reader can take records in any order.

Documents are range-partitioned by id and each task writes one shard, so shard names in order and
records in order give ascending ids. A task writes under a name of its own attempt and renames at
the end; a task that runs again replaces its shard with the same bytes.
"""

from __future__ import annotations

import uuid
import zlib
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .crc32c import crc32c, masked

_CACHE_WORDS = 800_000
_WORDS_AT_ONCE = 2_000
_TEXT_CHARS = 2 << 20
_FLUSH_BYTES = 8 << 20
NO_KEY = -(2**63)


class WordEncoder:
    """Whole-text encoding through a bounded cache of words.

    The tokenizer's splitting pattern never joins characters before and after a space that follows
    a non-space and precedes a non-space, so a text with no other spaces is the concatenation of its
    words, each with its leading space; and words new to the cache can be encoded as one text, cut
    before each id that begins with a space. Texts with other runs of spaces are encoded whole.
    """

    def __init__(self, path: str, width: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for piece, i in vocabulary.items() if piece.startswith("\u0120")]] = True  # stands for a space
        self.encode = tokenizer.encode_batch_fast
        self.width = np.dtype(width)
        self.words: dict[str, bytes] = {}

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.width).tobytes() for e in self.encode(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        size = self.width.itemsize
        for i in range(0, len(words), _WORDS_AT_ONCE):
            part = words[i : i + _WORDS_AT_ONCE]
            (whole,) = self.encode(["".join(f" {w}" for w in part)], add_special_tokens=False)
            ids = np.array(whole.ids, dtype=self.width)
            at = (np.flatnonzero(self.spaced[ids]) * size).tolist()
            if len(at) == len(part):
                data = ids.tobytes()
                self.words.update(zip(part, [data[a:b] for a, b in zip(at, [*at[1:], len(data)])]))
            else:
                self.words.update(zip(part, self._bytes([f" {w}" for w in part])))

    def __call__(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if "  " in t or t[:1] == " " or t[-1:] == " "]
        whole = dict(zip(odd, self._bytes([texts[i] for i in odd])))
        split = [(i, t.split(" ")) for i, t in enumerate(texts) if i not in whole]
        heads = self._bytes([words[0] for _, words in split])
        words, out = self.words, [b""] * len(texts)
        for i in odd:
            out[i] = whole[i]
        needed = set().union(*(rest[1:] for _, rest in split))
        missing = needed.difference(words)
        if len(words) + len(missing) > _CACHE_WORDS:
            words.clear()
            missing = needed
        self._learn(list(missing))
        for head, (i, rest) in zip(heads, split):
            out[i] = b"".join([head, *map(words.__getitem__, rest[1:])])
        return out


@lru_cache(maxsize=1)
def encoder_for(path: str, width: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs one after the other."""
    return WordEncoder(path, width)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _frames(keys: list[int], payloads: list[bytes]) -> list[bytes]:
    bodies = [k.to_bytes(8, "little", signed=True) + p for k, p in zip(keys, payloads)]
    heads = [len(b).to_bytes(8, "little") for b in bodies]
    head_crc = masked(crc32c(heads)).astype("<u4").tobytes()
    body_crc = masked(crc32c(bodies)).astype("<u4").tobytes()
    return [
        b"".join((h, head_crc[i : i + 4], b, body_crc[i : i + 4]))
        for h, b, i in zip(heads, bodies, range(0, 4 * len(bodies), 4))
    ]


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    vocabulary: int = 1 << 16,
    shards: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode whole texts and write the shards below ``path``; one row per shard that was written.

    Returns ``shard, path, n_docs, n_tokens, width``. Texts that are null are empty, ``end_id`` ends
    each document, ids of ``vocabulary`` up to 65536 take two bytes. Rows with a null key come first
    under the smallest long; repeated rows are repeated records; an empty table writes no shard. The frame
    is lazy like any other: the files are there once it has run.
    """
    path = path.rstrip("/")
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = rows.repartitionByRange(shards, "key") if shards else rows.repartitionByRange("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        task = TaskContext.get()
        shard, attempt = task.partitionId(), f"{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        encode, end = encoder_for(tokenizer, width), np.array([end_id], dtype=width).tobytes()
        store, root = _filesystem(path)
        out, offset, index, n_tokens = None, 0, [], 0
        keys, texts, size = [], [], 0

        def flush():
            nonlocal offset, n_tokens, size
            payloads = [p + end for p in encode(texts)]
            for k, p, frame in zip(keys, payloads, _frames(keys, payloads)):
                index.append((k, offset, len(frame), len(p) // end_size))
                offset += len(frame)
                n_tokens += len(p) // end_size
                out.write(frame)
            keys.clear()
            texts.clear()
            size = 0

        end_size = len(end)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/.{shard:06d}-{attempt}.rec")
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(k)
                texts.append(body.as_py())
                size += len(texts[-1])
                if size > _TEXT_CHARS:
                    flush()
        if out is None:
            return
        flush()
        out.close()
        table = pa.table([pa.array(c, pa.int64()) for c in zip(*index)], names=["key", "offset", "size", "n_tokens"])
        with store.open_output_stream(f"{root}/.{shard:06d}-{attempt}.idx") as f:
            pq.write_table(table, f)
        for kind in ("idx", "rec"):
            store.move(f"{root}/.{shard:06d}-{attempt}.{kind}", f"{root}/{shard:06d}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (shard, f"{path}/{shard:06d}", len(index), n_tokens, width)],
            names=["shard", "path", "n_docs", "n_tokens", "width"],
        )

    return rows.sortWithinPartitions("key").mapInArrow(
        run, "shard long, path string, n_docs long, n_tokens long, width string"
    )


def read_frames(stream) -> Iterator[tuple[int, bytes]]:
    """Key and payload of each record of an open shard, in file order; a damaged record is an error."""
    held: list[tuple[bytes, bytes, bytes]] = []
    size = 0

    def checked():
        heads, bodies = [h[:8] for h, _, _ in held], [b for _, b, _ in held]
        want = np.frombuffer(b"".join(h[8:] for h, _, _ in held), "<u4"), np.frombuffer(b"".join(c for _, _, c in held), "<u4")
        for have, strings in zip(want, (heads, bodies)):
            if (masked(crc32c(strings)) != have).any():
                raise ValueError("a record does not match its checksum")
        for b in bodies:
            yield int.from_bytes(b[:8], "little", signed=True), b[8:]

    while head := stream.read(12):
        length = int.from_bytes(head[:8], "little")
        if len(head) < 12 or length > 1 << 40:
            raise ValueError("a record is cut off")
        body, crc = stream.read(length), stream.read(4)
        if len(crc) < 4:
            raise ValueError("a record is cut off")
        held.append((head, body, crc))
        size += length
        if size > _FLUSH_BYTES:
            yield from checked()
            held, size = [], 0
    yield from checked()


def read_digests(shards: DataFrame) -> DataFrame:
    """Per document, read back from the shard files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it: the running total of whole shards (one
    narrow row each) plus the count inside its shard.
    """
    spark = shards.sparkSession
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    todo = shards.select("path", "width", "n_docs", before.alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, width, _, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, root = _filesystem(f"{path}.rec")
                rows = []
                with store.open_input_stream(root, buffer_size=1 << 20) as f:
                    for key, payload in read_frames(f):
                        ids = np.frombuffer(payload, width)
                        rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) >= 10_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    parts = max(1, spark.sparkContext.defaultParallelism)
    read = todo.repartition(parts * 4, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_KEY)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
    )


def read_at(path: str, offset: int, size: int, width: str = "<u2") -> tuple[int, np.ndarray]:
    """One record by its index entry: key and ids."""
    store, root = _filesystem(f"{path}.rec")
    with store.open_input_file(root) as f:
        f.seek(offset)
        (key, payload), = read_frames(pa.BufferReader(f.read(size)))
    return key, np.frombuffer(payload, width)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
