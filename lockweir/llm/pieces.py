"""SentencePiece encoding and decoding on a relational lattice.

Texts are cut where no piece of the vocabulary can reach across; what lies between cuts are words,
and only distinct words are encoded. Of each word all substrings up to the longest piece are
exploded and joined with the piece table on equality; the pieces found are the edges of the word's
lattice, grouped by word and folded with a higher-order aggregate: the best path by summed scores
(Viterbi) for a unigram model, or, for a BPE model, whose encoding is no best path, the merges in
order of score on the same lattice. Both folds keep their state in a few numbers per word.

Documents are held in blocks of bounded size: a block keeps, per occurrence, the number of a word, and
sends its distinct words away in packets, one for each part of all words. A part meets the packets of all
blocks, encodes its distinct words, and answers each packet with one of ids. The blocks themselves are
stored in buckets and never move; only packets do, and no (block, word) row.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_in_buckets
from .expressions import let

SPACE = "▁"
_UNIT = re.compile(r"▁*(?:[^\W\d_]+|\d+|(?:[^\w▁]|_)+)|▁+")
_COARSE = re.compile(r"▁*[^▁]+|▁+")
# Positions of a word are bits of a long, of which two are left free.
LONGEST_WORD = 61
BLOCK_CHARS = 6_000_000
# So many words become ids at a time.
_CHUNK = 1 << 17
# More parts than this make packets of a few words, unless there are as many tasks.
MOST_PARTS = 1024


@dataclass
class Vocabulary:
    """The pieces of a model that match text, with ids and scores, and the ids of its bytes."""

    path: str
    pieces: list[tuple[str, int, float]]
    first_byte: int
    crossing: list[str]
    longest: int
    unknown: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        bytes_ = [i for i in ids if sp.is_byte(i)]
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        pieces = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in plain]
        crossing = [p for p, _, _ in pieces if not _UNIT.fullmatch(p)]
        return cls(path, pieces, bytes_[0] if bytes_ else -1, crossing, max(len(p) for p, _, _ in pieces), sp.unk_id())


def _words(text: str) -> list[str]:
    """The words of a text, each without the first of the marks before it; the first has the dummy prefix."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return re.findall("▁(▁*[^▁]*)", SPACE + text.replace(" ", SPACE))
    return text.split(" ")


def _units(word: str, crossing: list[str]) -> list[str]:
    return (_COARSE if any(c in word for c in crossing) else _UNIT).findall(word)


def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed: the lowest bytes of all, then the next ones."""
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(values.astype("<u4").view("u1").reshape(-1, 4).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers given in order of first appearance: a first one is told as zero, any other as one more."""
    before = np.maximum.accumulate(np.r_[np.int32(-1), numbers])[:-1]
    return _pack(np.where(numbers > before, 0, numbers + 1))


def _unpack_numbers(data: bytes) -> np.ndarray:
    told = _unpack(data)
    return np.where(told == 0, np.cumsum(told == 0, dtype=np.int32) - 1, told - 1).astype(np.int32)


def _ragged(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows one after the other, and the offsets of the rows in them."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[rows] - (ends - sizes), sizes)
    return values[at], np.r_[0, ends]


BLOCK_SCHEMA = (
    "block long, keys array<long>, checks array<long>, sizes binary, codes binary, word_sizes binary, word_units binary, "
    "unit_parts binary, packets array<string>"
)


def blocks(docs: DataFrame, vocabulary: Vocabulary, parts: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in blocks of about ``BLOCK_CHARS`` code points (one document at least).

    Words and their units are numbered by first appearance, and no text is held once it is read. A packet has the block's number and the units of one
    part in this order, apart by blanks, which no unit holds; it is null if there are none.
    """
    crossing = vocabulary.crossing

    def close(name, keys, checks, number, codes):
        units: dict[str, int] = {}
        word_units, word_sizes = array("i"), array("i")
        for w in number:
            cut_up = _units(SPACE + w, crossing)
            word_units.extend(units.setdefault(u, len(units)) for u in cut_up)
            word_sizes.append(len(cut_up))
        number.clear()
        unit_parts = [zlib.crc32(u.encode()) % parts for u in units]
        packets: list[list[str]] = [[] for _ in range(parts)]
        for u, p in zip(units, unit_parts):
            packets[p].append(u)
        packets = [" ".join([str(name), *p]) if p else None for p in packets]
        sizes = np.array([len(c) for c in codes])
        codes = np.concatenate([np.array(c, np.int32) for c in codes])
        cols = [[name], [keys], [checks], [_pack(sizes)], [_pack_numbers(codes)], [_pack(np.array(word_sizes))],
                [_pack_numbers(np.array(word_units, np.int32))], [_pack(np.array(unit_parts))], [packets]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.list_(pa.string())]
        names = [c.split(" ")[0] for c in BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, size = TaskContext.get().partitionId(), 0, 0
        keys, checks, codes = [], [], []
        number: dict[str, int] = {}
        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                text = t.as_py() or ""
                keys.append(k.as_py())
                checks.append(zlib.crc32(text.encode()))
                codes.append(array("i", [number.setdefault(w, len(number)) for w in _words(text)]))
                size += len(text)
                if size >= BLOCK_CHARS:
                    yield close((task << 32) + n, keys, checks, number, codes)
                    keys, checks, codes, number, size, n = [], [], [], {}, 0, n + 1
        if keys:
            yield close((task << 32) + n, keys, checks, number, codes)

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, BLOCK_SCHEMA)


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, edges`` for distinct words: the pieces ``(cost, start, stop, id, ends, within)`` that match in each.

    ``cost`` is the negated score, so that edges are sorted from the best score and from the left;
    ``ends`` and ``within`` are sets of positions, one bit each: the two ends, and what lies between.
    A single character that is no piece has a null id and infinite cost. ``words`` must be distinct; Spark then keeps
    its partitioning by word, or by another column (which stays), and neither the join with the piece table (as
    large as the model's vocabulary, hence broadcast) nor the grouping moves a row.
    """
    spark = words.sparkSession
    kept = [c for c in words.columns if c != "word"]
    table = spark.createDataFrame(
        [(p, i, s) for p, i, s in vocabulary.pieces], "piece string, id int, score double"
    )
    length = F.length("word")
    starts = words.select(*kept, "word", F.explode(F.sequence(F.lit(0), length - 1)).alias("start"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), length - F.col("start")))
    spans = starts.select(*kept, "word", "start", F.explode(sizes).alias("size")).select(
        *kept, "word", "start", "size", F.substring("word", F.col("start") + 1, F.col("size")).alias("piece")
    )
    found = spans.join(F.broadcast(table), "piece", "left").filter("id IS NOT NULL OR size = 1")
    stop = F.col("start") + F.col("size")
    edge = F.struct(
        (-F.coalesce(F.col("score"), F.lit(float("-inf")))).alias("cost"), "start", stop.alias("stop"), "id",
        _bit(F.col("start")).bitwiseOR(_bit(stop)).alias("ends"), (_bit(stop) - _bit(F.col("start") + 1)).alias("within"),
    )
    # The hash comes first because rows are sorted to be grouped, and numbers sort faster than words.
    keys = [F.xxhash64("word").alias("hash"), *kept, "word"]
    return found.select(*keys, edge.alias("edge")).groupBy("hash", *kept, "word").agg(
        F.sort_array(F.collect_list("edge")).alias("edges")
    )


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def merged_path(word: Column, edges: Column) -> Column:
    """Ids of a BPE encoding: on the lattice, the best-scored piece made of two neighbours is merged
    until there is none; of equal scores the leftmost first.

    The state is a set of boundaries, one bit each. A piece can be merged if its ends are boundaries
    and exactly one lies within.
    """
    n = F.length(word)
    done = F.lit(-(1 << 63))  # the sign bit: nothing is left to merge

    def fold(longer: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            can = lambda e: (state.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(state.bitwiseAND(e["within"])) == 1)
            merged = state.bitwiseAND(F.bitwise_not(F.get(F.filter(longer, can), F.lit(0))["within"]))
            return F.when(state < 0, state).otherwise(F.coalesce(merged, state.bitwiseOR(done)))

        return F.aggregate(F.sequence(F.lit(1), n), _bit(n + 1) - 1, step)

    def chosen(edges: Column) -> Column:
        final = let(F.filter(edges, lambda e: e["within"] != 0), fold)
        return let(
            final,
            lambda state: F.filter(
                edges, lambda e: (state.bitwiseAND(e["ends"]) == e["ends"]) & (state.bitwiseAND(e["within"]) == 0)
            ),
        )

    return F.sort_array(F.transform(chosen(edges), lambda e: F.struct(e["start"], e["stop"], e["id"])))


def best_path(word: Column, edges: Column, penalty: float) -> Column:
    """Edges of the path with the highest summed score (Viterbi); of equal sums the longer last piece.

    A character that is no piece costs ``penalty``. The state is, per position reached so far, the
    best sum and the edge it ends with; a word has at most ``LONGEST_WORD`` positions.
    """
    cell = "struct<sum:double,start:int,stop:int,id:int>"
    zero = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(None).cast("int").alias("id")).cast(cell))

    def step(reached: Column, stop: Column) -> Column:
        here = F.transform(
            F.filter(edges, lambda e: e["stop"] == stop),
            lambda e: F.struct(
                (F.get(reached, e["start"])["sum"] + F.when(e["id"].isNull(), penalty).otherwise(-e["cost"])).alias("sum"),
                (-e["start"]).alias("back"), e["id"].alias("id"),
            ),
        )
        as_cell = lambda best: F.struct(
            best["sum"].alias("sum"), (-best["back"]).alias("start"), stop.alias("stop"), best["id"].alias("id")
        ).cast(cell)
        return F.concat(reached, F.array(let(F.array_max(here), as_cell)))

    reached = F.aggregate(F.sequence(F.lit(1), F.length(word)), zero, step)

    def back(state: Column, cells: Column) -> Column:
        at = F.coalesce(F.get(state, F.lit(0))["start"], F.length(word))
        c = F.get(cells, at)
        edge = F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["id"].alias("id"))
        return F.when(at > 0, F.concat(F.array(edge), state)).otherwise(state)

    walk = lambda cells: F.aggregate(
        F.sequence(F.lit(1), F.length(word)), F.array().cast("array<struct<start:int,stop:int,id:int>>"), lambda s, _: back(s, cells)
    )
    return let(reached, walk)


def with_bytes(word: Column, path: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a path; a character that is no piece becomes its UTF-8 bytes, or the unknown id."""
    hexed = lambda e: F.hex(F.encode(F.substring(word, e["start"] + 1, F.lit(1)), "UTF-8"))
    if vocabulary.first_byte < 0:
        return F.transform(path, lambda e: F.coalesce(e["id"], F.lit(vocabulary.unknown)))
    split = lambda h: F.transform(
        F.sequence(F.lit(0), F.floor(F.length(h) / 2).cast("int") - 1),
        lambda i: F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + vocabulary.first_byte,
    )
    bytes_ = lambda e: let(hexed(e), split)
    listed = F.flatten(F.transform(path, lambda e: F.when(e["id"].isNull(), bytes_(e)).otherwise(F.array(e["id"]))))
    return F.when(F.exists(path, lambda e: e["id"].isNull()), listed).otherwise(F.transform(path, lambda e: e["id"]))


def _has_no_lattice() -> Column:
    """Words of more than ``LONGEST_WORD`` code points, and runs of blanks (whose pieces tie)."""
    return (F.length("word") > LONGEST_WORD) | F.col("word").contains(SPACE * 2)


def _by_lattice(words: DataFrame, vocabulary: Vocabulary, kind: str) -> DataFrame:
    """``ids`` for each distinct ``word`` that has a lattice; other columns stay."""
    kept = [c for c in words.columns if c != "word"]
    small = lattice(words.filter(~_has_no_lattice()), vocabulary)
    if kind == "bpe":
        path = merged_path(F.col("word"), F.col("edges"))
    else:
        path = best_path(F.col("word"), F.col("edges"), min(s for _, _, s in vocabulary.pieces) - 10.0)
    return small.select(*kept, "word", path.alias("path")).select(
        *kept, "word", with_bytes(F.col("word"), F.col("path"), vocabulary).alias("ids")
    )


def encode_words(words: DataFrame, vocabulary: Vocabulary, kind: str = "bpe") -> DataFrame:
    """``word, ids`` for each distinct ``word``.

    Words that have no lattice of bounded size are encoded by the model itself, one word at a time.
    """
    model = vocabulary.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or (_word_encoder(model) if batch.num_rows else None)
            ids = [encoder(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    odd = words.select("word").filter(_has_no_lattice())
    return _by_lattice(words.select("word"), vocabulary, kind).unionByName(odd.mapInArrow(run, "word string, ids array<int>"))


@lru_cache(maxsize=1)
def _word_encoder(model: str):
    """Encode a word as it stands in a text: the prefix the model would add is there already or not wanted."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    guard = sp.encode("\x00", out_type=int)  # what the prefix and a character that joins nothing become

    def encode(word: str) -> list[int]:
        return sp.encode("\x00" + word.replace(SPACE, " "), out_type=int)[len(guard):]

    return encode


def encode(docs: DataFrame, vocabulary: Vocabulary, kind: str = "bpe", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, check`` for each document; ``check`` is the crc32 of its text.

    The ids are those of the model for the whole text with its dummy prefix and without special ids.
    Null and empty texts have no ids; null keys and repeated rows come out as they are; an empty
    table gives no rows; other columns are ignored.
    """
    # A lattice is many times as large as its word, so its partitions are not sized by the words' bytes.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(4 * tasks, max(tasks, MOST_PARTS))
    packed = cut_in_buckets(blocks(docs, vocabulary, parts, key, text), "block", parts)
    # The block's number stays within the packet: both uses then read the same columns of one shuffle.
    packets = (
        packed.select(F.posexplode("packets").alias("part", "packet")).filter("packet IS NOT NULL").repartition(parts, "part")
    )
    listed = F.split("packet", " ")
    words = packets.select("part", F.explode(F.slice(listed, F.lit(2), F.size(listed))).alias("word")).distinct()
    # A name of its own, as both sides of the cogroup come from the same rows.
    encoded = _by_lattice(words, vocabulary, kind).select(F.col("part").alias("of"), "word", _as_bytes(F.col("ids")).alias("ids"))
    model = vocabulary.path

    def answer(packets: pa.Table, encoded: pa.Table) -> pa.Table:
        lists = pc.split_pattern(packets.column("packet").combine_chunks(), " ")
        flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        heads, sizes = offsets[:-1], np.diff(offsets) - 1
        told = np.delete(np.arange(len(flat)), heads)
        units = flat.take(pa.array(told))
        known = encoded.column("word").combine_chunks()
        rows = pc.index_in(units, value_set=known)
        odd = units.filter(rows.is_null()).unique()
        wrong = [w for w in odd.to_pylist() if len(w) <= LONGEST_WORD and SPACE * 2 not in w]
        if wrong:
            raise ValueError(f"words without ids: {wrong[:3]}")
        encoder = _word_encoder(model) if len(odd) else None
        ids = encoded.column("ids").to_pylist() + [np.array(encoder(w), ">u4").tobytes() for w in odd.to_pylist()]
        at = np.where(
            rows.is_null().to_numpy(zero_copy_only=False), len(known) + pc.index_in(units, value_set=odd).fill_null(0).to_numpy(),
            rows.fill_null(0).to_numpy(),
        )
        values = np.frombuffer(b"".join(ids), ">u4").astype(np.int64)
        starts = np.r_[0, np.cumsum([len(x) // 4 for x in ids])].astype(np.int64)
        each, ends = _ragged(starts, values, at)
        first = np.r_[0, np.cumsum(sizes)]
        spans = [(a, b) for a, b in zip(first[:-1], first[1:])]
        of = flat.take(pa.array(heads)).cast(pa.int64())
        part = pa.array([packets.column("part")[0].as_py()] * len(of), pa.int32())
        unit_sizes = pa.array([_pack(np.diff(ends[a : b + 1])) for a, b in spans], pa.binary())
        return pa.table(
            [of, part, unit_sizes, pa.array([_pack(each[ends[a] : ends[b]]) for a, b in spans], pa.binary())],
            names=["of", "part", "unit_sizes", "ids"],
        )

    answers = packets.groupBy("part").cogroup(encoded.groupBy("of")).applyInArrow(
        answer, "of long, part int, unit_sizes binary, ids binary"
    )

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        get = lambda name: block.column(name)[0]
        sizes, codes, word_sizes = _unpack(get("sizes").as_py()), _unpack_numbers(get("codes").as_py()), _unpack(get("word_sizes").as_py())
        word_units, unit_parts = _unpack_numbers(get("word_units").as_py()), _unpack(get("unit_parts").as_py())
        answers = answers.sort_by("part")
        joined = lambda name: np.concatenate([np.zeros(0, np.int32), *[_unpack(x) for x in answers.column(name).to_pylist()]])
        unit_sizes = joined("unit_sizes")
        if len(unit_sizes) != len(unit_parts):
            raise ValueError(f"a block of {len(unit_parts)} units got {len(unit_sizes)}")
        place = np.empty(len(unit_parts), np.int64)  # of a unit among those of all parts
        place[np.argsort(unit_parts, kind="stable")] = np.arange(len(unit_parts))
        unit_offsets = np.r_[0, np.cumsum(unit_sizes)].astype(np.int64)
        per_unit, ends = _ragged(unit_offsets, joined("ids"), place[word_units])
        word_offsets = ends[np.r_[0, np.cumsum(word_sizes)].astype(np.int64)]
        chunks = [_ragged(word_offsets, per_unit, codes[i : i + _CHUNK])[0] for i in range(0, len(codes), _CHUNK)]
        ids = np.concatenate([np.zeros(0, np.int32), *chunks])
        ends = np.r_[0, np.cumsum(np.diff(word_offsets)[codes])]
        doc_offsets = ends[np.r_[0, np.cumsum(sizes)].astype(np.int64)]
        lists = pa.ListArray.from_arrays(pa.array(doc_offsets.astype(np.int32)), pa.array(ids))
        return pa.table([get("keys").values, lists, get("checks").values], names=["doc_id", "ids", "check"])

    return packed.drop("packets").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(
        run, "doc_id long, ids array<int>, check long"
    )


def _as_bytes(ids: Column) -> Column:
    """Four bytes for each id, the highest first: a quarter of what a row with an array takes in a shuffle."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.lpad(F.hex(i), 8, "0")), ""))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that ids stand for: pieces and bytes put together, the dummy prefix left out.

    No ids give an empty text, a null list a null one; bytes that are no UTF-8 become U+FFFD.
    """
    kept = [c for c in encoded.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*kept).schema.fields)
    raw = {i: p.replace(SPACE, " ").encode() for p, i, _ in vocabulary.pieces}
    if vocabulary.first_byte >= 0:
        raw |= {vocabulary.first_byte + b: bytes([b]) for b in range(256)}
    parts = [raw.get(i, b"") for i in range(max(raw) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = np.r_[0, np.cumsum([len(p) for p in parts])]
        values = np.frombuffer(b"".join(parts), np.uint8)
        at = kept.index(ids)
        for batch in batches:
            texts = []
            for row in batch.column(at):
                if not row.is_valid:
                    texts.append(None)
                    continue
                body, _ = _ragged(offsets, values, row.values.to_numpy().astype(np.int64))
                whole = body.tobytes().decode(errors="replace")
                texts.append(whole[1:] if whole[:1] == " " else whole)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, text])

    return encoded.select(*kept).mapInArrow(run, f"{schema}, `{text}` string")
