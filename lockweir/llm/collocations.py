"""Phrase collocations, counted exactly in counting quotient filters that are merged across shards.

Texts become blocks of word ids, the ids being dense over the frequent words of each language. A phrase of m
words is the id of its first m - 1 words beside the id of its last word, packed into one number.
An invertible permutation spreads these numbers; their high bits are the quotient and all the other
bits the remainder, so a filter loses nothing and can be read back (``encode``, ``decode``). Each block
counts its phrases and cuts its filter at the same ranges of the permuted numbers; the pieces of a range
are merged in order and their counts added.

Phrases are counted level by level: a phrase of m words can only be frequent if both its parts of
m - 1 words are. So the merged ranges answer each piece with the entries that are frequent, and the
blocks go on from there. A word or phrase is shuffled once per block however often it occurs there.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

_BLOCK_BYTES = 8 << 20
_RANGE_TOKENS = 1 << 20
_MOST_RANGES = 16
_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
_SEPARATORS = b".,;:!?\n\v\f\r"
_TABLE = bytes(
    10 if c in _SEPARATORS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


# ---------------------------------------------------------------- filters


def permute(x: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    """An invertible permutation of the numbers below ``2 ** bits`` (at most 64), or its inverse."""
    mask = np.uint64((1 << bits) - 1)
    shift = np.uint64(bits - bits // 2)  # at least half of the bits, so that the fold undoes itself
    x = x.astype(np.uint64)
    for odd in reversed(_ODD) if back else _ODD:
        odd = odd % (1 << bits) | 1
        if back:
            x = x ^ (x >> shift)
            x = x * np.uint64(pow(odd, -1, 1 << bits)) & mask
        else:
            x = x * np.uint64(odd) & mask
            x = x ^ (x >> shift)
    return x


def encode(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of sorted distinct ``values`` below ``2 ** bits``.

    Per entry: its quotient in unary (one bit for each quotient passed and one for the entry), its
    whole remainder in bytes, and its count in one byte, or in eight more from 255 on.
    """
    n = len(values)
    high = min(bits, max(0, (n - 1).bit_length()))
    low = bits - high
    quotient = values >> np.uint64(low) if low < 64 else np.zeros(n, np.uint64)
    marks = np.zeros(n + (1 << high), np.uint8)
    marks[quotient.astype(np.int64) + np.arange(n)] = 1
    width = -(-low // 8)
    rest = (values & np.uint64((1 << low) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    short = np.minimum(counts, 255).astype(np.uint8)
    return b"".join(
        [n.to_bytes(8, "little"), bytes([high, bits]), np.packbits(marks).tobytes(), rest.tobytes(), short.tobytes(),
         counts[short == 255].astype("<i8").tobytes()]
    )


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The values, in order, and counts of a filter."""
    n, high, bits = int.from_bytes(data[:8], "little"), data[8], data[9]
    low = bits - high
    width, at = -(-low // 8), 10
    size = n + (1 << high)
    marks = np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size)
    at += -(-size // 8)
    quotient = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    long = counts == 255
    counts[long] = np.frombuffer(data, "<i8", int(long.sum()), at + n)
    high_part = quotient << np.uint64(low) if low < 64 else np.zeros(n, np.uint64)
    return high_part | rest.view("<u8").ravel().astype(np.uint64), counts


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Values and summed counts of several filters; neighbours are merged first, so few are open at once."""
    stack: list[tuple[int, np.ndarray, np.ndarray]] = []

    def join():
        _, v, c = stack.pop()
        level, w, d = stack.pop()
        values = np.concatenate([w, v])
        order = np.argsort(values, kind="stable")  # a merge of two sorted runs
        values, counts = values[order], np.concatenate([d, c])[order]
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
        stack.append((level + 1, values[starts], np.add.reduceat(counts, starts) if len(starts) else counts))

    for data in filters:
        stack.append((0, *decode(data)))
        while len(stack) > 1 and stack[-1][0] == stack[-2][0]:
            join()
    while len(stack) > 1:
        join()
    return stack[0][1:] if stack else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


# ---------------------------------------------------------------- blocks


def _pack(values: np.ndarray) -> bytes:
    small = not len(values) or bool(values.max() < 1 << 31)
    return bytes([small]) + zlib.compress(values.astype("<i4" if small else "<i8").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), "<i4" if data[0] else "<i8").astype(np.int64)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _blocks(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``block, tokens, words``: local ids of words in order, -1 between pieces, and the block's words with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        ids: dict[str, _Ids] = {}
        tokens: list[np.ndarray] = []
        size = 0

        def told():
            nonlocal made, size
            langs, words, start, base = [], [], {}, 0
            for name, known in ids.items():
                start[name] = base
                langs += [name] * (len(known) - 2)
                words += [w.decode() for w in list(known)[2:]]
                base += len(known) - 2
            flat = [np.where(t < 0, t, t + start[name]) for name, t in tokens]
            flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
            counts = np.bincount(flat[flat >= 0], minlength=len(words))
            listed = pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"]
            )
            block = task << 32 | made
            made, size = made + 1, 0
            ids.clear()
            tokens.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([_pack(flat)]), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), listed)],
                names=["block", "tokens", "words"],
            )

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = (body.as_py() or "").encode()
                if name not in ids:
                    ids[name] = _Ids({b"": 0, b"\n": 1})
                parts = body.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
                parts.append(b"\n")
                found = np.fromiter(map(ids[name].__getitem__, parts), np.int64, len(parts))
                found = found[found != 0] - 2
                tokens.append((name, found))
                size += len(body)
                if size > _BLOCK_BYTES:
                    yield told()
        if tokens:
            yield told()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text))
    return rows.mapInArrow(run, "block long, tokens binary, words array<struct<lang:string,word:string,n:long>>")


def _numbered(rows: DataFrame) -> DataFrame:
    """Add a dense ``id``. The counts of rows by partition go through the driver: one number for each."""
    spark = rows.sparkSession
    raw = cut(rows.withColumn("raw", F.monotonically_increasing_id()))
    part = F.shiftright("raw", 33)
    sizes = sorted((r["part"], r["count"]) for r in raw.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    offsets = spark.createDataFrame(starts, "part long, first long")
    numbered = raw.join(F.broadcast(offsets), part == F.col("part"))
    return numbered.select(*rows.columns, (F.col("first") + F.col("raw").bitwiseAND((1 << 33) - 1)).alias("id"))


def _keys(words: np.ndarray, grams: np.ndarray, length: int, word_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where both parts of a phrase of ``length`` words are frequent, and the packed phrases there."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero((grams[:n] >= 0) & (grams[1 : n + 1] >= 0))
    return at, grams[at].astype(np.uint64) << np.uint64(word_bits) | words[at + length - 1].astype(np.uint64)


def _level(state: DataFrame, length: int, bits: int, word_bits: int, cuts: int, least: int, last: bool):
    """Count phrases of ``length`` words; ``(frequent, their number, state of the next level)``."""
    rest = bits - cuts

    def distinct(words, grams):
        at, keys = _keys(_unpack(words), _unpack(grams), length, word_bits)
        values, inverse, counts = np.unique(permute(keys, bits), return_inverse=True, return_counts=True)
        edges = np.searchsorted(values, np.arange(1, 1 << cuts, dtype=np.uint64) << np.uint64(rest))
        return at, values, inverse, counts, np.r_[0, edges, len(values)]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, grams in zip(*(c.to_pylist() for c in batch.columns)):
                _, values, _, counts, edges = distinct(words, grams)
                own = values & np.uint64((1 << rest) - 1)
                full = [r for r in range(1 << cuts) if edges[r] < edges[r + 1]]
                data = [encode(own[edges[r] : edges[r + 1]], counts[edges[r] : edges[r + 1]], rest) for r in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()), pa.array(data, pa.binary())],
                    names=["range", "block", "data"],
                )

    def merged(table: pa.Table) -> pa.Table:
        values, counts = merge([d.as_py() for d in table.column("data")])
        kept = counts >= least
        data = [values[kept].astype("<u8").tobytes()], [counts[kept].astype("<i8").tobytes()]
        return pa.table(
            [table.column("range")[:1], pa.array([int(kept.sum())]), *(pa.array(d, pa.binary()) for d in data)],
            names=["range", "n", "values", "counts"],
        )

    def answers(pieces: pa.Table, frequent: pa.Table) -> pa.Table:
        known = np.frombuffer(frequent.column("values")[0].as_py(), "<u8")
        first = starts[frequent.column("range")[0].as_py()]
        out = []
        for data in pieces.column("data"):
            values, _ = decode(data.as_py())
            to = np.searchsorted(known, values)
            hit = np.flatnonzero(known[np.minimum(to, len(known) - 1)] == values) if len(known) else np.zeros(0, np.int64)
            out.append(_pack(np.concatenate([hit, to[hit] + first])))
        return pa.table([pieces.column("range"), pieces.column("block"), pa.array(out, pa.binary())], names=["range", "of", "answer"])

    def onward(block: pa.Table, told: pa.Table) -> pa.Table:
        words, grams = (block.column(c)[0].as_py() for c in ("words", "grams"))
        at, values, inverse, _, edges = distinct(words, grams)
        ids = np.full(len(values), -1, np.int64)
        for r, answer in zip(told.column("range").to_pylist(), told.column("answer")):
            answer = _unpack(answer.as_py())
            half = len(answer) // 2
            ids[edges[r] + answer[:half]] = answer[half:]
        longer = np.full(len(_unpack(words)), -1, np.int64)
        longer[at] = ids[inverse]
        return pa.table([block.column("block"), block.column("words"), pa.array([_pack(longer)], pa.binary())], names=["block", "words", "grams"])

    pieces = cut(state.mapInArrow(cut_up, "range int, block long, data binary"))
    frequent = cut(pieces.groupBy("range").applyInArrow(merged, "range int, n long, values binary, counts binary"))
    starts, total = {}, 0
    for r in sorted(frequent.select("range", "n").collect()):
        starts[r["range"]] = total
        total += r["n"]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, n, values, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(values, "<u8").astype(np.uint64)
                keys = permute(own | np.uint64(r) << np.uint64(rest) if rest < 64 else own, bits, back=True)
                columns = (
                    np.arange(n) + starts[r], (keys >> np.uint64(word_bits)).astype(np.int64),
                    (keys & np.uint64((1 << word_bits) - 1)).astype(np.int64), np.frombuffer(counts, "<i8"),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "front", "last", "a"])

    rows = frequent.mapInArrow(listed, "id long, front long, last long, a long")
    if not last:
        told = pieces.groupBy("range").cogroup(frequent.groupBy("range")).applyInArrow(answers, "range int, of long, answer binary")
        state = cut(
            state.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(onward, "block long, words binary, grams binary")
        )
    return rows, total, state


def phrases(docs: DataFrame, longest: int = 4, least: int = 30, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact counts of frequent phrases: ``(words, grams, totals)``.

    ``words`` has ``lang, word, n, id`` for words with at least ``least`` occurrences in a language, ``grams`` has
    ``ids, a`` for phrases of 2 to ``longest`` of them, and ``totals`` has ``lang, n`` over all words.
    """
    spark = docs.sparkSession
    packed = cut(_blocks(docs, lang, text))
    listed = packed.select("block", F.posexplode("words").alias("at", "w")).select("block", "at", "w.*")
    counted = listed.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = cut(_numbered(counted.filter(F.col("n") >= least)))
    size, tokens = words.count(), counted.agg(F.sum("n")).first()[0] or 0
    word_bits = max(1, size.bit_length())
    cuts = min(_MOST_RANGES, (tokens // _RANGE_TOKENS).bit_length())

    known = listed.join(words.select("lang", "word", "id"), ["lang", "word"]).select("block", "at", "id")
    told = known.groupBy("block").agg(F.collect_list(F.struct("at", "id")).alias("known"))
    here = packed.select("block", "tokens", F.size("words").alias("size")).join(told, "block", "left")

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.full(batch.column(2)[i].as_py() + 1, -1, np.int64)  # the last stands for -1
                pairs = batch.column(3)[i]
                if pairs.is_valid:
                    ids[pairs.values.field(0).to_numpy()] = pairs.values.field(1).to_numpy()
                data = pa.array([_pack(ids[_unpack(batch.column(1)[i].as_py())])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), data, data], names=["block", "words", "grams"])

    state = cut(here.mapInArrow(renamed, "block long, words binary, grams binary"))
    grams, found, total = None, None, size
    for length in range(2, longest + 1):
        bits = max(total.bit_length(), 1) + word_bits
        if bits > 64:
            raise ValueError("a phrase needs more than 64 bits: too many frequent phrases")
        rows, total, state = _level(state, length, bits, word_bits, min(cuts, bits - 1), least, length == longest)
        if length == 2:
            found = rows.select("id", F.array("front", "last").alias("ids"), "a")
        else:
            front = found.select(F.col("id").alias("front"), F.col("ids").alias("begin"))
            found = rows.join(front, "front").select("id", F.concat("begin", F.array("last")).alias("ids"), "a")
        found = cut(found)
        part = found.select("ids", "a")
        grams = part if grams is None else grams.unionByName(part)
    if grams is None:
        grams = spark.createDataFrame([], "ids array<long>, a long")
    return words, grams, totals


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, share: int = 80, most: int = 2000, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``most`` phrases.

    A phrase of 2 to ``longest`` words with ``a`` occurrences, ``least`` at least, scores
    ``floor(2000000 * a / (l + r))`` at its lowest-scoring cut (of equals the first), with the counts of both
    parts. It is dropped if it lies within a longer one that has ``share`` percent of its occurrences. Ties go to
    the greater ``a``, then to the first phrase in byte order.

    Null texts are empty, null languages ``und``; ids are not looked at, so repeated rows count again; an empty
    table gives no rows; other columns are ignored.
    """
    words, grams, totals = phrases(docs, longest, least, lang, text)
    counts = grams.unionByName(words.select(F.array("id").alias("ids"), F.col("n").alias("a")))
    size = F.size("ids")
    # All parts of a phrase: those cut off at one of its ends give the score, all of two words or more may be dropped.
    spans = F.flatten(F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.transform(F.sequence(F.lit(1), size - i + 1), lambda n: F.struct(i.alias("i"), n.alias("n"))),
    ))
    parts = grams.select("ids", "a", F.explode(F.filter(spans, lambda s: s["n"] < size)).alias("s"))
    parts = parts.select("ids", "a", "s.i", "s.n", F.slice("ids", F.col("s.i"), F.col("s.n")).alias("part"))
    known = cut(parts.join(counts.select(F.col("ids").alias("part"), F.col("a").alias("f")), "part"))
    dropped = known.filter((F.col("n") > 1) & (100 * F.col("a") >= share * F.col("f"))).select(F.col("part").alias("ids")).distinct()
    k = F.when(F.col("i") == 1, F.col("n")).otherwise(F.col("i") - 1)
    ends = known.filter((F.col("i") == 1) | (F.col("i") + F.col("n") == size + 1)).select(
        "ids", "a", k.alias("k"), F.when(F.col("i") == 1, F.col("f")).alias("l"), F.when(F.col("i") > 1, F.col("f")).alias("r")
    )
    halves = ends.groupBy("ids", "a", "k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    score = F.expr("CAST(a AS DECIMAL(19, 0)) * CAST(2000000 AS DECIMAL(7, 0)) DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    scored = halves.withColumn("score", score).groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = scored.join(dropped, "ids", "left_anti").select("ids", "a", "cut.score", "cut.l", "cut.r")
    first = words.select(F.col("id").alias("head"), "lang")
    of_lang = kept.join(first, F.get("ids", F.lit(0)) == F.col("head")).drop("head")
    # Words are needed for ties only, so they are looked up for what may be among the best.
    better = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = cut(of_lang.withColumn("place", F.rank().over(better)).filter(F.col("place") <= most).drop("place"))
    spelt = best.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = best.join(spelt, "ids").select(
        "lang", F.array_join(F.transform("w", lambda w: w["word"]), " ").alias("phrase"), "a", "l", "r", "score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
