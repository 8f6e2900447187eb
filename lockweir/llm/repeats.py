"""Removal of long strings that stand earlier in the corpus, by prefix-free parsing.

A rolling hash over 32 bytes chooses the triggers: each window of ``length`` bytes has the 32 bytes of smallest hash
in it as its trigger, so no window is without one, and equal windows have it at the same place. All windows
that share a trigger follow each other; together they are a phrase, about 70 bytes longer than the trigger.
Texts become a parse, the phrases in order, over a dictionary of distinct phrases, which is small
where texts repeat. A phrase that stands earlier as a whole repeats in all its windows.

What is left are distinct phrases that share a trigger. Their windows are put into corpus order by two sorted
arrays: the parse order, phrases sorted by what follows the trigger with the common prefixes of neighbours, and
the dictionary order, phrases put into classes by what precedes it. Two windows are equal if their phrases are
in one class up to the window's start and in one run of the parse order up to its end (``first_windows``).
The phrases of a trigger that has very many are ordered in shares, whose earliest windows are merged by their strings.

Triggers that occur once need nothing of this. They are found first: each block of texts sends its triggers' hashes as
compact sorted filters, cut at the same ranges, and is told which of them occur elsewhere or again. The blocks
are a table bucketed by block, so the answers travel to the texts and the texts never move.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, shared_dir
from .collocations import decode, encode, merge

_GRAM = 32
_STRETCH = 1 << 20
_BLOCK_BYTES = 4 << 20
_RANGE_BYTES = 1 << 24
_MOST_CUTS = 16
_SHARE = 4096
_LAST = (1 << 63) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each byte on; doubling lengths, it is the polynomial that also rolls."""
    h, size, factor = _BYTES[data], 1, 0x9E3779B97F4A7C15
    while size < _GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    return _mixed(h)


def _least(keys: np.ndarray, over: int) -> np.ndarray:
    """The least of ``over`` keys from each place on."""
    size = 1
    while 2 * size <= over:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - over + size], keys[over - size :]) if over > size else keys


def phrases(data: np.ndarray, sizes: np.ndarray, length: int = 100) -> tuple[np.ndarray, ...]:
    """``(slot, trigger, first, last, hash)``: the phrases of several texts that lie in ``data`` one after the other.

    ``first`` and ``last`` are the starts of a phrase's first and last window; places count from the start of ``data``.
    """
    ends = np.cumsum(sizes)
    grams = length - _GRAM + 1
    out = []
    for lo in range(0, len(data), _STRETCH):
        part = data[lo : lo + _STRETCH + length - 1]
        if len(part) < length:
            break
        hashes = _grams(part)
        keys = hashes & np.uint64(0xFFFFFFFF00000000) | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(keys, grams) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.arange(len(at)) + lo
        slot = np.searchsorted(ends, start, side="right")
        fits = np.flatnonzero(start + length <= ends[np.minimum(slot, len(ends) - 1)])
        at, start, slot = at[fits], start[fits], slot[fits]
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (slot[1:] != slot[:-1])]) if len(at) else np.zeros(0, np.int64)
        last = np.r_[new[1:], len(at)] - 1
        out.append((slot[new], at[new] + lo, start[new], start[last], hashes[at[new]]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    slot, at, first, last, hashes = (np.concatenate(c) for c in zip(*out))
    # A phrase that goes on in the next stretch was told in two.
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    return slot[new], at[new], first[new], last[np.r_[new[1:], len(at)] - 1] if len(at) else last, hashes[new]


def first_windows(
    trigger: np.ndarray, before: np.ndarray, after: np.ndarray, least: np.ndarray, most: np.ndarray, place: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """For each number of bytes before the trigger, the phrases whose window there is the earliest of its equals.

    ``before`` has the bytes before the trigger, the nearest first, ``after`` those from the trigger on (as many as a
    window has); windows of a phrase begin ``least`` to ``most`` bytes before it. ``place`` ranks the phrases.
    """
    n, length = after.shape
    wide = np.zeros((n, -(-length // 8) * 8), np.uint8)
    wide[:, :length] = after
    columns = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*columns.T[::-1], trigger))
    trigger, before, after = trigger[order], before[order], after[order]
    least, most, place = least[order], most[order], place[order]
    differs = after[1:] != after[:-1]
    alike = np.where(differs.any(1), differs.argmax(1), length) if n > 1 else np.zeros(0, np.int64)
    alike = np.where(trigger[1:] == trigger[:-1], alike, -1)
    kind = np.cumsum(np.r_[0, trigger[1:] != trigger[:-1]])
    for ahead in range(int(most.max()) + 1 if n else 0):
        if ahead:
            _, kind = np.unique(kind * 256 + before[:, ahead - 1], return_inverse=True)
        run = np.cumsum(np.r_[0, alike < length - ahead])
        on = np.flatnonzero((least <= ahead) & (ahead <= most))
        if len(on):
            by_place = on[np.argsort(place[on], kind="stable")]
            _, at = np.unique(kind[by_place] * (n + 1) + run[by_place], return_index=True)
            yield ahead, order[by_place[at]]


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a table in the shared folder whose rows are found by ``key`` without a shuffle."""
    spark, name = df.sparkSession, f"lockweir_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def _blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``block, docs, sizes, data``: texts as bytes, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def told():
            nonlocal made, size
            row = [{"block": task << 32 | made, "docs": list(ids), "sizes": [len(t) for t in texts], "data": b"".join(texts)}]
            made, size = made + 1, 0
            ids.clear()
            texts.clear()
            return pa.RecordBatch.from_pylist(row, schema)

        schema = pa.schema({"block": pa.int64(), "docs": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "data": pa.binary()})
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                texts.append((body.as_py() or "").encode())
                size += len(texts[-1])
                if size > _BLOCK_BYTES:
                    yield told()
        if ids:
            yield told()

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(
        run, "block long, docs array<long>, sizes array<long>, data binary"
    )


def _parsed(block: pa.Table | pa.RecordBatch, row: int, length: int):
    data = np.frombuffer(block.column("data")[row].as_py(), np.uint8)
    sizes = np.array(block.column("sizes")[row].as_py(), np.int64)
    return data, sizes, phrases(data, sizes, length)


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def without_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row.

    Removed is each byte that lies in a string of ``length`` bytes that also starts earlier: in a document of smaller id, or
    further left. Null texts are empty. Rows with a null id come after all others; rows of one id count as
    documents of their own, in the order of a hash of their texts, so a repeated row loses what the first keeps.
    Texts shorter than ``length`` stay as they are; an empty table gives no rows; other columns are ignored.
    """
    if not _GRAM < length <= 1000:
        raise ValueError(f"strings of {_GRAM + 1} to 1000 bytes")
    spark = docs.sparkSession
    blocks = _bucketed(_blocks(docs, key, text), "block")
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    cuts = min(_MOST_CUTS, (size // _RANGE_BYTES).bit_length())
    rest = 64 - cuts

    def distinct(hashes):
        values, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        edges = np.searchsorted(values, np.arange(1, 1 << cuts, dtype=np.uint64) << np.uint64(rest % 64))
        return values, inverse, counts, np.r_[0, edges, len(values)]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values, _, counts, edges = distinct(_parsed(batch, row, length)[2][4])
                values = values & np.uint64((1 << rest) - 1)
                full = [r for r in range(1 << cuts) if edges[r] < edges[r + 1]]
                data = [encode(values[edges[r] : edges[r + 1]], counts[edges[r] : edges[r + 1]], rest) for r in full]
                block = pa.array([batch.column("block")[row].as_py()] * len(full), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), block, pa.array(data, pa.binary())], names=["range", "block", "data"])

    def merged(table: pa.Table) -> pa.Table:
        values, counts = merge([d.as_py() for d in table.column("data")])
        return pa.table([table.column("range")[:1], pa.array([values[counts > 1].tobytes()], pa.binary())], names=["range", "values"])

    def answers(pieces: pa.Table, again: pa.Table) -> pa.Table:
        known = np.frombuffer(again.column("values")[0].as_py(), np.uint64)
        out = []
        for data in pieces.column("data"):
            values, _ = decode(data.as_py())
            to = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
            out.append(np.packbits(known[to] == values if len(known) else np.zeros(len(values), bool)).tobytes())
        return pa.table([pieces.column("range"), pieces.column("block"), pa.array(out, pa.binary())], names=["range", "of", "answer"])

    pieces = cut(blocks.mapInArrow(cut_up, "range int, block long, data binary"))
    again = cut(pieces.groupBy("range").applyInArrow(merged, "range int, values binary"))
    told = pieces.groupBy("range").cogroup(again.groupBy("range")).applyInArrow(answers, "range int, of long, answer binary")

    def occurrences(block: pa.Table, told: pa.Table) -> pa.Table:
        """Phrases whose trigger occurs again, with the hash of the phrase and of the text they lie in."""
        import xxhash

        data, sizes, (slot, at, first, last, hashes) = _parsed(block, 0, length)
        values, inverse, _, edges = distinct(hashes)
        hit = np.zeros(len(values), bool)
        for r, answer in zip(told.column("range").to_pylist(), told.column("answer")):
            n = edges[r + 1] - edges[r]
            hit[edges[r] : edges[r + 1]] = np.unpackbits(np.frombuffer(answer.as_py(), np.uint8), count=n)
        on = np.flatnonzero(hit[inverse])
        slot, at, first, last, hashes = slot[on], at[on], first[on], last[on], hashes[on]
        starts = np.r_[0, np.cumsum(sizes)]
        view = memoryview(data)
        digest = [
            xxhash.xxh3_128_intdigest(view[a : b + length], (t - a) * 1024 + t - b + 512)
            for t, a, b in zip(at.tolist(), first.tolist(), last.tolist())
        ]
        ids = block.column("docs")[0].as_py()
        texts = {s: _signed(xxhash.xxh3_64_intdigest(view[starts[s] : starts[s + 1]])) for s in np.unique(slot).tolist()}
        return pa.table(
            {
                "g": hashes.view(np.int64), "h1": [_signed(d >> 64) for d in digest], "h2": [_signed(d & (1 << 64) - 1) for d in digest],
                "doc": pa.array([_LAST if ids[s] is None else ids[s] for s in slot.tolist()], pa.int64()),
                "hash": pa.array([texts[s] for s in slot.tolist()], pa.int64()),
                "block": np.full(len(slot), block.column("block")[0].as_py(), np.int64), "slot": slot, "at": at - starts[slot],
                "most": at - first, "least": at - last,
            },
            schema=pa.schema([(c, pa.int64()) for c in _OCCURRENCE]),
        )

    kinds = ", ".join(f"{c} long" for c in _OCCURRENCE)
    found = cut(blocks.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(occurrences, kinds))
    same, place = ["g", "h1", "h2"], F.struct("doc", "hash", "block", "slot", "at")
    dictionary = cut(
        found.groupBy(*same, "most", "least").agg(F.min(place).alias("place"), F.count("*").alias("n")).select(*same, "most", "least", "n", "place")
    )
    earliest = dictionary.filter("n > 1").select(*same, "place")
    later = found.join(earliest, same).filter(place != F.col("place")).select("block", "slot", "at", "most", "least", F.lit(0).alias("kind"))
    triggers = dictionary.groupBy("g").count().filter("count > 1")
    rivals = cut(dictionary.join(triggers, "g").select("g", "count", "most", "least", "place.*"))

    def spelt(block: pa.Table, asked: pa.Table) -> pa.Table:
        data = block.column("data")[0].as_py()
        starts = np.r_[0, np.cumsum(np.array(block.column("sizes")[0].as_py(), np.int64))]
        get = lambda c: asked.column(c).to_numpy()
        at = starts[get("slot")] + get("at")
        bodies = [data[a:b] for a, b in zip((at - get("most")).tolist(), (at - get("least") + length).tolist())]
        return asked.append_column("body", pa.array(bodies, pa.binary())).select([*_RIVAL, "body"])

    asked = rivals.withColumnRenamed("block", "of").withColumn("block", F.col("of")).select(*_RIVAL, "of")
    kinds = ", ".join(f"{c} long" for c in _RIVAL)
    bodies = blocks.groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(spelt, f"{kinds}, body binary")
    share = F.pmod(F.xxhash64("doc", "slot", "at"), F.ceil(F.col("count") / _SHARE))
    bodies = bodies.withColumn("share", share).repartition("g", "share").sortWithinPartitions("g", "share")

    def compared(rows: pa.Table) -> pa.Table:
        """Runs of windows that repeat among ``rows``; where a trigger has other shares, its earliest windows and their hashes."""
        import xxhash

        n = rows.num_rows
        get = {c: rows.column(c).to_numpy() for c in _RIVAL}
        listed = rows.column("body").to_pylist()
        most, least = get["most"], get["least"]
        before, after = np.zeros((n, int(most.max())), np.uint8), np.zeros((n, length), np.uint8)
        for i, (body, ahead) in enumerate(zip(listed, most.tolist())):
            row = np.frombuffer(body, np.uint8)
            before[i, :ahead] = row[:ahead][::-1]
            after[i, : len(row) - ahead] = row[ahead : ahead + length]
        by_place = np.lexsort([get[c] for c in ("at", "slot", "block", "hash", "doc")])
        rank = np.empty(n, np.int64)
        rank[by_place] = np.arange(n)
        step = np.arange(int(most.max()) + 1)
        again = (least[:, None] <= step) & (step <= most[:, None])
        alone = get["count"] <= _SHARE
        firsts = []
        for ahead, at in first_windows(get["g"], before, after, least, most, rank):
            again[at, ahead] = False
            at = at[~alone[at]]
            firsts.append((at, np.full(len(at), ahead)))
        again[~alone] = False
        turns = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (at, low), (_, high) = np.nonzero(turns == 1), np.nonzero(turns == -1)
        other, ahead = (np.concatenate(c) for c in zip(*firsts))
        digest = [xxhash.xxh3_128_intdigest(listed[i][a : a + length]) for i, a in zip(other.tolist(), (most[other] - ahead).tolist())]
        both = np.concatenate([at, other])
        columns = {c: get[c][both] for c in ("doc", "hash", "block", "slot", "at")}
        columns |= {"most": np.concatenate([high - 1, ahead]), "least": np.concatenate([low, ahead])}
        none = [None] * len(at)
        columns |= {"h1": none + [_signed(d >> 64) for d in digest], "h2": none + [_signed(d & (1 << 64) - 1) for d in digest]}
        return pa.table([pa.array(columns[c], pa.int64()) for c in _COMPARED], names=_COMPARED)

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 2 * _SHARE:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            g, share = rows.column("g").to_numpy(), rows.column("share").to_numpy()
            whole = int(np.flatnonzero((g != g[-1]) | (share != share[-1]))[-1]) + 1 if (g[0], share[0]) != (g[-1], share[-1]) else 0
            if whole:
                yield from compared(rows.slice(0, whole)).to_batches()
            held, size = rows.slice(whole).to_batches(), size - whole
        if size:
            yield from compared(pa.Table.from_batches(held)).to_batches()

    told = cut(bodies.mapInArrow(ordered, ", ".join(f"{c} long" for c in _COMPARED)))
    start = F.struct("doc", "hash", "block", "slot", (F.col("at") - F.col("most")).alias("at"))
    kept = told.filter("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min(start).alias("p"))
    nothing = F.lit(0).cast("long")
    mark = ("block", "slot", "at", "most", "least")
    marks = (
        later.unionByName(told.filter("h1 IS NULL").select(*mark, F.lit(0).alias("kind")))
        .unionByName(rivals.filter(F.col("count") > _SHARE).select(*mark, F.lit(1).alias("kind")))
        .unionByName(kept.select("p.block", "p.slot", "p.at", nothing.alias("most"), nothing.alias("least"), F.lit(2).alias("kind")))
        .withColumnRenamed("block", "of")
    )

    def cleaned(block: pa.Table, marks: pa.Table) -> pa.Table:
        data = np.frombuffer(block.column("data")[0].as_py(), np.uint8)
        sizes = np.array(block.column("sizes")[0].as_py(), np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        get = {c: marks.column(c).to_numpy() for c in ("slot", "at", "most", "least", "kind")}
        at = starts[get["slot"]] + get["at"]
        ranges = get["kind"] < 2
        turns = np.zeros(len(data) + 1, np.int32)
        np.add.at(turns, (at - get["most"])[ranges], 1)
        np.add.at(turns, (at - get["least"])[ranges] + 1, -1)
        again = np.cumsum(turns[:-1]) > 0
        again[at[~ranges]] = False  # windows that stand here first
        turns[:] = 0
        turns[:-1] += again
        turns[length:] -= again[: len(data) + 1 - length] if len(data) >= length else 0
        gone = np.cumsum(turns[:-1]) > 0
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        heads = starts[sizes > 0]
        rises[heads] = gone[heads]
        upto, spans = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(rises)]
        digests = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(starts.tolist(), ends.tolist())]
        return pa.table(
            {
                "doc_id": pa.array(block.column("docs")[0].as_py(), pa.int64()), "n_bytes": sizes,
                "n_removed": upto[ends] - upto[starts], "n_spans": spans[ends] - spans[starts], "kept_sha256": digests,
            }
        )

    return blocks.groupBy("block").cogroup(marks.groupBy("of")).applyInArrow(
        cleaned, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


_OCCURRENCE = ["g", "h1", "h2", "doc", "hash", "block", "slot", "at", "most", "least"]
_RIVAL = ["g", "count", "most", "least", "doc", "hash", "block", "slot", "at"]
_COMPARED = ["h1", "h2", "doc", "hash", "block", "slot", "at", "most", "least"]
