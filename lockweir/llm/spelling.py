"""Spelling variants of a corpus' words: pairs at one edit, by dynamic programming along sorted lists.

Cut the shorter of two words at one edit in three: two of the parts stand in both words, at its ends
or around the third. So the vocabulary is dealt into lists by the length of the shorter word and two
of three parts, and only what is left of the words has to be within one edit. A list is sorted by
that. For each of its words the list is scanned with a matrix of edit distances of which only three
cells a row are kept: rows of the characters that a word shares with the one before stand already,
and where all cells of a row pass one edit, the words with that prefix are skipped by one search.

A pair that shares other parts too is told by the first list that has it. A list of more than
``most`` words is scanned in shares: each has the whole list, and its share of the words to scan for.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from os.path import commonprefix
from typing import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

_RUNS = re.compile(r"[A-Za-zÀ-ÿ]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
_LAST = "\U0010ffff"
_HELD = 400_000
_PARTS = 3


def word_counts(docs: DataFrame, one_in: int = 97, least_length: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: words of at least ``least_length`` code points in all texts, with their occurrences.

    Words are runs of Latin letters, A-Z in lower case. A run whose crc32 with its document's id is
    divisible by ``one_in`` loses one code point, at that crc32 modulo its length. Null texts have no words;
    a null id counts as an empty one; repeated rows count as often as they stand there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def told():
            out = pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                if not body:
                    continue
                head = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                for word, n in Counter(_RUNS.findall(body.translate(_LOWER))).items():
                    drawn = zlib.crc32(word.encode(), head)
                    if not drawn % one_in:
                        at = drawn % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) > _HELD:
                    yield told()
        if total:
            yield told()

    counted = docs.select(F.col(key), F.col(text)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def scan(words: list[str], shared: int, chosen: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Index pairs ``(a, b)``, ``a < b`` and ``a`` of ``chosen``, of sorted ``words`` at exactly one edit.

    All words begin with the same ``shared`` characters. ``rows[d]`` has the distances from the first ``d``
    characters of a scanned word to the first ``d - 1``, ``d`` and ``d + 1`` of the query; two stands for more than one.
    """
    n = len(words)
    common = [shared, *(len(commonprefix(pair)) for pair in zip(words, words[1:])), 0]
    for a in chosen:
        size = len(words[a])
        query = words[a] + "\0\0\0"
        rows = [(2, 0, 1)] + [(1, 0, 1)] * (size + 2)
        b, depth = a + 1, common[a + 1]
        while b < n:
            word = words[b]
            length = len(word)
            less, same, more = rows[depth]
            while depth < length:
                if depth > size:
                    break
                c = word[depth]
                less = min(less + (c != query[depth - 1]), same + 1)
                same = min(same + (c != query[depth]), more + 1, less + 1)
                more = min(more + (c != query[depth + 1]), same + 1)
                depth += 1
                rows[depth] = (less, same, more)
                if less > 1 and same > 1 and more > 1:
                    break
            else:
                if -1 <= size - length <= 1 and rows[length][size - length + 1] == 1:
                    yield a, b
                b += 1
                depth = min(depth, common[b])
                continue
            b = bisect_left(words, word[:depth] + _LAST, b + 1)
            depth = len(commonprefix((word, words[b]))) if b < n else 0


def _kept(size, part: int, whole=int):
    """Lengths of what is kept before and after part ``part`` of a word of ``size``."""
    return whole(size * part / _PARTS), size - whole(size * (part + 1) / _PARTS)


def near_pairs(vocabulary: DataFrame, most: int = 20_000) -> DataFrame:
    """``word, n, near, near_n``: each pair of words at exactly one edit, told from both sides.

    ``vocabulary`` has distinct ``word`` of two or more code points, with ``n``.
    """
    size = F.length("word")

    def place(l, part):
        prefix, suffix = _kept(l, part, lambda x: F.floor(x).cast("int"))
        ends = F.concat(F.substring("word", F.lit(1), prefix), F.substring("word", size - suffix + 1, suffix))
        free = F.substring("word", prefix + 1, size - prefix - suffix)
        return F.struct(F.lit(part).alias("part"), l.alias("size"), ends.alias("ends"), free.alias("free"))

    places = F.array(*(place(l, part) for l in (size, size - 1) for part in range(_PARTS)))
    dealt = vocabulary.select("word", "n", F.explode(F.filter(places, lambda p: p["size"] > 0)).alias("p")).select("word", "n", "p.*")
    keys = ["part", "size", "ends"]
    large = dealt.groupBy(*keys).count().filter(F.col("count") > most)
    shares = large.select(*keys, F.ceil(F.col("count") / most).cast("int").alias("shares"))
    split = dealt.join(shares, keys, "left").select(
        *keys, "free", "word", "n", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share"),
        F.coalesce(F.pmod(F.xxhash64("word"), F.col("shares")), F.lit(0)).alias("own"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str, int]] = []

        def told():
            columns = list(zip(*out)) or [(), (), (), ()]
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "n", "near", "near_n"]
            )

        def close(group, free, words, counts, chosen):
            part, size, _, _ = group
            earlier = [_kept(size, i) for i in range(part)]
            for a, b in scan(free, 0, chosen):
                x, y = words[a], words[b]
                if len(x) > size and len(y) > size:
                    continue
                if any(x[:p] == y[:p] and (not s or x[-s:] == y[-s:]) for p, s in earlier):
                    continue
                out.append((x, counts[a], y, counts[b]))
                out.append((y, counts[b], x, counts[a]))

        group, free, words, counts, chosen = None, [], [], [], []
        for batch in batches:
            for part, size, ends, middle, word, n, share, own in zip(*(c.to_pylist() for c in batch.columns)):
                if group != (part, size, ends, share):
                    if len(free) > 1:
                        close(group, free, words, counts, chosen)
                        if len(out) > 50_000:
                            yield told()
                    group, free, words, counts, chosen = (part, size, ends, share), [], [], [], []
                if own == share:
                    chosen.append(len(free))
                free.append(middle)
                words.append(word)
                counts.append(n)
        if len(free) > 1:
            close(group, free, words, counts, chosen)
        yield told()

    dealt_out = split.repartition(*keys, "share").sortWithinPartitions(*keys, "share", "free")
    return dealt_out.mapInArrow(run, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from each ``word`` of ``forms`` (``word, form``) along the forms to the last.

    Each round joins the table with itself and doubles the steps taken; chains are short, as each
    form is at least twice as frequent as its word.
    """
    state = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = state.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = cut(
            state.join(on, state["root"] == on["at"], "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        )
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def variants(docs: DataFrame, one_in: int = 97, least_length: int = 5, least: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word with at least ``least`` occurrences.

    ``form`` is the most frequent word at one edit (of equals the first in code-point order) if it is at
    least twice as frequent, else null; ``root`` is where forms lead to. See ``word_counts`` for null
    ids, null and empty texts and repeated rows; an empty table gives no rows; other columns are ignored.
    """
    if least_length < 2:
        raise ValueError("words need two code points at least")
    vocabulary = cut(word_counts(docs, one_in, least_length, key, text).filter(F.col("n") >= least))
    near = near_pairs(vocabulary).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    )
    formed = cut(
        near.select("word", "n_near", F.when(-F.col("best.n") >= 2 * F.col("n"), F.col("best.word")).alias("form"), (-F.col("best.n")).alias("best_n"))
    )
    ends = roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return (
        vocabulary.join(formed, "word", "left").join(ends, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
        )
    )
