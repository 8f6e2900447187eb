"""Near-duplicates by SimHash with deletion-variant signatures.

Fingerprints of 64 bits link when they differ in at most two. Cut in two halves, one half then
differs in at most one bit: either the low half does, or the low half takes both and the high half
is equal. So each distinct fingerprint is indexed under its low half with one bit left out (32
keys) and under its high half (one key), and two fingerprints that link meet under at least one key:
an equality join finds all links, and each meeting is verified. A link is told once, at the first
key of the two.

A key under which many fingerprints meet is not joined with itself. Its fingerprints are indexed
again by the bits of the whole fingerprint with two left out: all that share such a key link by
construction, and at most four distinct fingerprints can share it, so nothing is missed and no
group grows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .components import components

_HALF = 0xFFFFFFFF
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash over the XXH64 (seed 42) of word shingles, as an unsigned integer."""
    import xxhash

    hash64 = xxhash.xxh64_intdigest
    parts = text.lower().split()  # on bytes: A-Z only, and the six ASCII blanks
    if not parts:
        return 0
    if len(parts) < words:
        shingles = iter([b" ".join(parts)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
        n = len(parts) - words + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        size = min(_CHUNK, n - start)
        h = np.fromiter((hash64(next(shingles), 42) for _ in range(size)), np.uint64, size)
        ones += np.unpackbits(h.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` for each row; a text that is null or has no words has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint((t.as_py() or "").encode(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, "doc_id long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _first_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of the first key that two linked fingerprints share."""
    low = (a ^ b) & np.uint64(_HALF)
    return np.where(low == 0, 0, np.where(_popcount(low) == 1, _popcount(low - np.uint64(1)), 32))


def _meet(max_distance: int, most: int):
    """Walk through sorted ``(key, fp)`` rows; tell links of small keys and all rows of large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(kind, a, b):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                names=["kind", "a", "b"],
            )

        held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        large = None  # the key whose rows are passed on as they come

        def close(key, fp):
            """All rows of the keys in the arrays are there, but for a key that is large already."""
            nonlocal large
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.r_[starts, len(key)])
            big = np.repeat((size > most) | (key[starts] == large if large is not None else False), size)
            if big.any():
                yield told(1, key[big].view(np.uint64), fp[big])
            key, fp = key[~big], fp[~big]
            for d in range(1, most):
                if len(key) <= d:
                    break
                same = np.flatnonzero(key[d:] == key[:-d])
                if not len(same):
                    break
                a, b = fp[same], fp[same + d]
                at = key[same] >> 32
                near = (_popcount(a ^ b) <= max_distance) & (a != b) & (_first_key(a, b) == at)
                if near.any():
                    yield told(0, a[near], b[near])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.r_[held_key, batch.column(0).to_numpy()]
            fp = np.r_[held_fp, batch.column(1).to_numpy().view(np.uint64)]
            stop = int(np.searchsorted(key, key[-1]))
            yield from close(key[:stop], fp[:stop])
            held_key, held_fp = key[stop:], fp[stop:]
            if large is not None and large != held_key[0]:
                large = None
            if len(held_key) > most:
                large = int(held_key[0])
                yield told(1, held_key.view(np.uint64), held_fp)
                held_key, held_fp = held_key[:0], held_fp[:0]
        yield from close(held_key, held_fp)

    return run


def half_keys(fp: str = "fp"):
    """The 33 keys of a fingerprint: a number in the upper bits, a half (one bit left out or none) below."""
    fp = F.col(fp)
    low = fp.bitwiseAND(_HALF)
    keys = [low.bitwiseAND(_HALF ^ 1 << b).bitwiseOR(b << 32) for b in range(32)]
    return F.array(*keys, F.shiftrightunsigned(fp, 32).bitwiseOR(32 << 32))


def _dense_links(rows: DataFrame) -> DataFrame:
    """Links among fingerprints of large keys, by keys of the whole fingerprint with two bits left out.

    ``rows`` holds ``(key, fp)``. Of a low key with bit p left out, links are wanted that have at most
    one bit of the high half besides; of key 0 also those with an equal low half and two bits of the
    high half; of the high key those with two bits of the low half.
    """
    bits = [F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)]
    bit = lambda i: F.element_at(F.array(*bits), i + 1)

    def pairs(first):
        return F.flatten(
            F.transform(
                F.sequence(F.lit(first), F.lit(first + 30)),
                lambda p: F.transform(F.sequence(p + 1, F.lit(first + 31)), lambda q: bit(p).bitwiseOR(bit(q))),
            )
        )

    at = F.shiftright(F.col("key"), 32).cast("int")
    one = F.transform(F.sequence(F.lit(32), F.lit(63)), lambda q: bit(at).bitwiseOR(bit(q)))
    masks = F.when(at == 32, pairs(0)).when(at == 0, F.concat(one, pairs(32))).otherwise(one)
    holes = rows.select("fp", F.explode(masks).alias("mask"))
    groups = holes.groupBy("mask", F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("rest")).agg(
        F.collect_set("fp").alias("fps")
    )
    linked = groups.filter(F.size("fps") > 1).select(F.array_sort("fps").alias("fps"))
    return linked.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 4)).alias("b"))


def links(fps: DataFrame, max_distance: int = 2, most: int = 32) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that differ in at most two bits.

    Every link is found; some links of a large key are told through a common neighbour instead,
    which leaves the components as they are. ``most`` only decides which way a key is dealt with.
    """
    if max_distance != 2:
        raise ValueError("the keys serve a distance of two")
    keyed = fps.select(F.explode(half_keys()).alias("key"), "fp")
    met = cut(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(max_distance, most), "kind int, a long, b long")
    )
    dense = _dense_links(met.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp")))
    return met.filter("kind = 0").select("a", "b").unionByName(dense)


def near_duplicates(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for each row: the component's smallest id, links being at most two bits.

    Rows with equal fingerprints are linked, texts without words among them (fingerprint zero). A
    null id never names a component unless it holds no other; repeated rows stay; an empty table
    gives no rows; other columns are ignored.
    """
    signed = cut(fingerprints(docs, words, key, text))
    distinct = cut(signed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct))
    grown = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "first")
    named = grown.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = grown.join(named, "root").select("fp", "component_id")
    all_fps = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return signed.join(all_fps, "fp").select("doc_id", "fp", "component_id")


# --- fixed values: keys of a text are 24 groups of four smallest hashes, so a pair at a Jaccard similarity
# of 0.8 shares none with a chance of (1 - 0.8^4)^24, about 3 in a million.
_BANDS, _ROWS = 24, 4
_DRAW = np.random.default_rng(42)
_TURN = _DRAW.integers(0, 2**31, _BANDS * _ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _DRAW.integers(0, 2**32, _BANDS * _ROWS, np.uint32)
_MARKS = 4
_MIX = _DRAW.integers(0, 2**63, (_ROWS + 1, _BANDS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, words: int = 5) -> set[bytes]:
    """The distinct word shingles; all words where there are fewer, none where there is no word."""
    parts = text.lower().split()
    if len(parts) < words:
        return {b" ".join(parts)} if parts else set()
    return set(map(b" ".join, zip(*(parts[i:] for i in range(words)))))


def copy_keys(shingles: set[bytes]) -> np.ndarray:
    """Keys of which two texts share at least one with a chance that grows steeply with their similarity."""
    import xxhash

    least = np.full(_BANDS * _ROWS, 0xFFFFFFFF, np.uint32)
    h = np.fromiter((xxhash.xxh32_intdigest(s, 42) for s in shingles), np.uint32, len(shingles))
    for start in range(0, len(h), 4096):
        turned = h[start : start + 4096, None] * _TURN + _ADD
        np.minimum(least, turned.min(0), out=least)
    groups = least.reshape(_BANDS, _ROWS).T.astype(np.uint64)
    mixed = (groups * _MIX[:_ROWS]).sum(0, dtype=np.uint64) + _MIX[_ROWS]
    return ((mixed ^ mixed >> np.uint64(29)) * _MIX[0, 0]).view(np.int64)


def _with_copy_keys(texts: DataFrame, words: int) -> DataFrame:
    """``node, n, fp, keys`` of each ``(node, text)``, ``n`` being the number of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, fps, keys = [], [], []
            for t in batch.column(1):
                body = t.as_py().encode()
                shingles = shingle_set(body, words)
                sizes.append(len(shingles))
                fps.append(fingerprint(body, words))
                keys.append(copy_keys(shingles))
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * _BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["node", "n", "fp", "keys"],
            )

    return texts.mapInArrow(run, "node long, n long, fp long, keys array<long>")


def _close_fingerprints(nodes: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of nodes by their fingerprints ``fp``: equal ones as a star, and links of at most two bits."""
    first = cut(nodes.groupBy("fp").agg(F.min("node").alias("first")))
    equal = nodes.join(first, "fp").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    side = lambda fp, c: first.select(F.col("fp").alias(fp), F.col("first").alias(c))
    linked = links(first.select("fp")).toDF("fp_a", "fp_b").join(side("fp_a", "a"), "fp_a").join(side("fp_b", "b"), "fp_b")
    return equal.unionByName(linked.select("a", "b"))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose shingle sets have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, set()
        for batch in batches:
            near = []
            for node, s, t in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if node != last:
                    last, x = node, shingle_set(s.as_py().encode(), words)
                y = shingle_set(t.as_py().encode(), words)
                both = len(x & y)
                near.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    pairs = cut(pairs.distinct())
    ends = cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    held = cut(texts.join(ends, "node", "left_semi").dropDuplicates(["node"]))
    side = lambda c: held.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return cut(joined.mapInArrow(run, "a long, b long"))


def _pairs_by_difference(members: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """Pairs ``(a, b)`` that may be near, among the ``node`` (with ``n``, ``root``) that have met the same ``first``.

    Let r be the shingles that most members have, D(x) what differs between x and r, and with
    c = (1 - similarity) / (1 + similarity) let slack(x) = c * |x| - |D(x)|. Two members are near if and only if D(x) and D(y)
    share at least -(slack(x) + slack(y)) / 2 shingles. If that is not above zero, both are near the member
    of the largest slack s as well: a star tells those. Else they share a shingle of D among the rarest ones, as
    many as the least overlap leaves (a prefix filter). One of the two, x, has slack(x) + s < 0 then, so the overlap
    is above (s - slack(y)) / 2, which leaves y ``half`` of its own; x meets those that the star reaches with ``most``,
    by an overlap of at least -(slack(x) + s) / 2, and the others with its own half.

    Shingles are few in 256 classes; a class whose parity differs between two texts holds a shingle that one of them lacks.
    So texts with more such classes than near ones have differing shingles are no pair.
    """
    c = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sets, marks = [], []
            for t in batch.column(1):
                h = np.array([xxhash.xxh64_intdigest(w, 42) for w in shingle_set(t.as_py().encode(), words)], np.uint64)
                sets.append(h.view(np.int64))
                marks.append(_parities(h))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64()))],
                names=["node", "tokens", "marks"],
            )

    met = cut(members.select("first", "node", "n", "root").distinct())
    told = texts.join(met.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    tokens = cut(told.mapInArrow(run, "node long, tokens array<long>, marks array<long>"))
    each = met.join(tokens, "node").select("first", "node", F.explode("tokens").alias("token"))
    groups = met.groupBy("first").agg(F.count("*").alias("size"))
    counts = cut(each.groupBy("first", "token").agg(F.count("*").alias("held")).filter("held > 1").join(groups, "first"))
    common = counts.filter("2 * held > size")
    whole = cut(common.groupBy("first").agg(F.collect_list("token").alias("common")))
    # What one member alone has or lacks meets nobody: it is counted, and only the rest becomes rows.
    shared = counts.select(
        "first", "token", F.when(F.expr("2 * held > size"), F.col("size") - F.col("held")).otherwise(F.col("held")).alias("held")
    ).filter("held > 1")
    apart = cut(
        met.join(tokens, "node").join(whole, "first", "left")
        .withColumn("common", F.coalesce("common", F.array().cast("array<long>")))
        .select(
            "first", "node", "n", "root", "marks",
            F.concat(F.array_except("tokens", "common"), F.array_except("common", "tokens")).alias("apart"),
        )
    )
    differ = cut(apart.select("first", "node", F.explode("apart").alias("token")).join(shared, ["first", "token"]))
    rows = differ.groupBy("first", "node").agg(F.count("*").alias("rows"))
    slack = cut(
        apart.withColumn("d", F.size("apart").cast("long")).drop("apart").join(rows, ["first", "node"], "left")
        .withColumn("alone", F.col("d") - F.coalesce("rows", F.lit(0))).drop("rows")
        .withColumn("slack", c * F.col("n") - F.col("d"))
    )
    best = cut(slack.groupBy("first").agg(F.max(F.struct("slack", "node")).alias("best")))
    slack = cut(
        slack.join(best, "first").withColumn("near", F.col("slack") + F.col("best.slack") >= -1e-6)
        .withColumn("half", F.col("d") - F.floor((F.col("best.slack") - F.col("slack")) / 2 - 1e-6))
        .withColumn("most", F.col("d") - F.ceil(-(F.col("best.slack") + F.col("slack")) / 2 - 1e-6) + 1)
    )
    star = slack.filter(F.col("near") & (F.col("node") != F.col("best.node"))).select(F.col("best.node").alias("a"), F.col("node").alias("b"))
    rarest = Window.partitionBy("first", "node").orderBy("held", "token")
    rare = cut(
        differ.withColumn("rank", F.row_number().over(rarest)).join(slack.drop("best", "slack", "d"), ["first", "node"])
        .withColumn("rank", F.col("rank") + F.col("alone"))
        .withColumn("short", F.col("rank") <= F.col("half")).filter(F.col("short") | ~F.col("near") & (F.col("rank") <= F.col("most")))
    )
    other = rare.filter("short").select("first", "token", *[F.col(x).alias(f"{x}_b") for x in ("node", "n", "root", "near", "marks")])
    unlike = sum(F.bit_count(F.get("marks", F.lit(i)).bitwiseXOR(F.get("marks_b", F.lit(i)))) for i in range(_MARKS))
    return star.unionByName(
        rare.filter("NOT near").join(other, ["first", "token"])
        .filter((F.col("root") != F.col("root_b")) & (F.col("near_b") | F.col("short") & (F.col("node") < F.col("node_b"))))
        .filter(F.least("n", "n_b") >= similarity * F.greatest("n", "n_b"))
        .filter(unlike <= c * (F.col("n") + F.col("n_b")) + 1e-6)
        .select(F.col("node").alias("a"), F.col("node_b").alias("b"))
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _parities(hashes: np.ndarray) -> np.ndarray:
    """One bit for each of 256 classes of hashes: whether their number is odd."""
    odd = np.bincount((hashes & np.uint64(64 * _MARKS - 1)).astype(np.int64), minlength=64 * _MARKS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def near_copies(
    docs: DataFrame, similarity: float = 0.8, words: int = 5, key: str = "doc_id", text: str = "text", most: int = 16
) -> DataFrame:
    """``doc_id, component_id`` for each row, links being a Jaccard similarity of word shingles of at least 0.8.

    Fingerprints of these shingles that differ in at most two bits are found by deletion variants (``links``). At
    that similarity about ten of 64 bits can differ, so texts that share a key of smallest hashes are candidates as
    well; each candidate is verified on the whole texts. One text of a key, the one that meets most others, is
    compared with all of it. Where some are then not in one component, they are compared in pairs if they
    are few (``most``), else by where they differ from what most of them share (``_pairs_by_difference``).

    Texts without words are copies of each other. Null ids and repeated rows as in ``near_duplicates``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("node"))
    texts = own.select("node", "text")
    nodes = cut(_with_copy_keys(texts, words).dropDuplicates(["node"]))
    keyed = nodes.select("node", "n", F.explode("keys").alias("key"))
    alike = lambda m, n: F.least(m, n) >= similarity * F.greatest(m, n)
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    held = cut(keyed.join(cut(sizes), "key"))
    weighed = held.join(held.groupBy("node").agg(F.sum("size").alias("weight")), "node")
    first = weighed.groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("first"))
    met = cut(held.join(cut(first), "key"))
    stars = met.filter((F.col("node") != F.col("first.node")) & alike(F.col("n"), F.col("first.n")))
    ends = [F.col("first.node"), F.col("node")]
    pairs = stars.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).unionByName(_close_fingerprints(nodes))
    near = _verified(pairs, texts, similarity, words)
    roots = cut(components(near))
    rest = cut(
        met.filter("size > 2").select("key", "size", F.col("first.node").alias("first"), "node", "n").join(roots, "node", "left")
        .select("key", "size", "first", "node", "n", F.coalesce("root", "node").alias("root"))
    )
    open_keys = rest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    rest = cut(rest.join(cut(open_keys.select("key")), "key", "left_semi"))
    few = rest.filter(F.col("size") <= most)
    other = few.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "root")])
    across = few.join(other, "key").filter((F.col("node") < F.col("node_b")) & (F.col("root") != F.col("root_b")))
    across = across.filter(alike(F.col("n"), F.col("n_b"))).select(F.col("node").alias("a"), F.col("node_b").alias("b"))
    across = across.unionByName(_pairs_by_difference(rest.filter(F.col("size") > most), texts, similarity, words))
    more = _verified(across, texts, similarity, words)
    roots = components(near.unionByName(more))
    rows = own.select("doc_id", "node").join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    rows = cut(rows)
    named = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(named, "root").select("doc_id", "component_id")
