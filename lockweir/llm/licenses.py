"""License scans by patience alignment.

A document is cut into regions around the telling words of a template, so that a notice that stands
there several times is found each time, and into stretches of template length and more around each
place where the template may start, whatever its neighbours are; of finds that overlap the best is
kept. In each, words that occur once in both it and the template are anchors; the longest increasing
subsequence of the anchors is kept, and the gaps between kept anchors are aligned in the same way.
Coverage is the share of the template's words that are aligned.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_texts import LICENSES

_WORD = re.compile(r"[^\W_]+")
# --- fixed values: words too common to make a region.
_COMMON = frozenset("a above and any are as at be by for in is it of on or that the this to under use with".split())


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given by first position, whose second positions increase."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        if k == len(tails):
            tails.append(b)
            at.append(i)
        else:
            tails[k], at[k] = b, i
        before.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned positions of two word lists, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = _increasing([(i, place[a[i]]) for i in range(a0, a1) if a[i] in place and in_a[a[i]] == 1])
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


@dataclass(frozen=True)
class Template:
    """A text to look for, and how often each of its telling words occurs in it."""

    name: str
    words: tuple[str, ...]
    telling: dict[str, int]

    @classmethod
    def of(cls, name: str, text: str) -> Template:
        words = words_of(text)
        telling = {w: n for w, n in Counter(words).items() if w not in _COMMON} or dict(Counter(words))
        return cls(name, tuple(words), telling)


def regions(marks: list[tuple[int, str]], template: Template) -> Iterator[tuple[int, int]]:
    """First and last position of each region, from the positions of telling words in a document.

    A region ends where the next telling word is further off than the template is long, or has
    occurred as often as in the template. Regions with fewer than half the telling words are left out.
    """
    seen: Counter[str] = Counter()
    first = last = None
    enough = 0.5 * sum(template.telling.values())
    for i, w in [*marks, (None, "")]:
        if first is not None and (i is None or i - last > len(template.words) or seen[w] >= template.telling[w]):
            if sum(seen.values()) >= enough:
                yield first, last
            first, seen = None, Counter()
        if i is None:
            return
        first = i if first is None else first
        last = i
        seen[w] += 1


def places(marks: list[tuple[int, str]], template: Template, n_words: int, coverage: float):
    """Where the template may start, likeliest first, each with the stretches of the document to align.

    Each telling word says where the template would start if the word stood at its place in it. The
    stretches have template length, and reach further on either side or both, whatever stands there.
    Stretches with too few telling words for the coverage are left out.
    """
    size, total = len(template.words), sum(template.telling.values())
    enough = max(1, min(0.5 * total, total - (1 - coverage) * size))
    if len(marks) < enough:
        return
    at: dict[str, list[int]] = {}
    for j, w in enumerate(template.words):
        if w in template.telling:
            at.setdefault(w, []).append(j)
    votes = Counter(i - j for i, w in marks for j in at[w])
    positions = [i for i, _ in marks]
    more = size // 4 + 1
    for start, _ in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
        ways = []
        for before, after in ((0, 0), (more, more), (0, size), (size, 0), (size, size)):
            low, high = max(0, start - before), min(n_words, start + size + after)
            a, b = bisect_left(positions, low), bisect_left(positions, high)
            if b - a < enough:
                continue
            seen = Counter(w for _, w in marks[a:b])
            if sum(min(n, template.telling[w]) for w, n in seen.items()) >= enough:
                ways.append((low, high))
        if ways:
            yield start, ways


def scan_words(words: list[str], templates: list[Template], coverage: float, density: float):
    """``(template, first word, last word, aligned words)`` of each find."""
    telling: dict[str, list[Template]] = {}
    for t in templates:
        for w in t.telling:
            telling.setdefault(w, []).append(t)
    marks: dict[str, list[tuple[int, str]]] = {}
    for i, w in enumerate(words):
        for t in telling.get(w, ()):
            marks.setdefault(t.name, []).append((i, w))
    for t in templates:
        own = marks.get(t.name, [])
        finds, tried = [], set()

        def align(low: int, high: int) -> tuple[int, int, int] | None:
            if (low, high) in tried:
                return None
            tried.add((low, high))
            pairs = patience(words[low:high], list(t.words))
            if len(pairs) < coverage * len(t.words):
                return None
            start, stop = low + pairs[0][0], low + pairs[-1][0]
            if len(pairs) < density * (stop - start + 1):
                return None
            finds.append((start, stop, len(pairs)))
            return finds[-1]

        spans = list(regions(own, t))
        for n, (first, last) in enumerate(spans):
            low = max(spans[n - 1][1] + 1 if n else 0, first - len(t.words))
            high = min(spans[n + 1][0] if n + 1 < len(spans) else len(words), last + 1 + len(t.words))
            align(low, high)
        whole: list[int] = []
        for start, ways in places(own, t, len(words), coverage):
            k = bisect_left(whole, start)
            if any(2 * abs(start - w) < len(t.words) for w in whole[max(0, k - 1) : k + 1]):
                continue  # in a whole copy
            for low, high in ways:
                found = align(low, high)
                if found and found[2] == len(t.words) == found[1] - found[0] + 1:
                    insort(whole, found[0])
                    break
        taken: list[tuple[int, int, int]] = []
        for find in sorted(set(finds), key=lambda f: (-f[2], f[1] - f[0], f[0])):
            k = bisect_left(taken, find)
            if (not k or taken[k - 1][1] < find[0]) and (k == len(taken) or find[1] < taken[k][0]):
                taken.insert(k, find)
        for start, stop, n in taken:
            yield t, start, stop, n


SCHEMA = "doc_id long, license string, start int, end int, aligned int, coverage double"


def scan(
    docs: DataFrame,
    licenses: list[tuple[str, str]] = LICENSES,
    coverage: float = 0.8,
    density: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each place of each whole text that holds a license, with code-point offsets.

    A place counts if at least ``coverage`` of the template's words are aligned there and make up at
    least ``density`` of the words between the first and the last. Null and empty texts hold nothing,
    null ids are told as null, repeated rows are scanned each, an empty table or list of licenses
    gives no rows, other columns are ignored.
    """
    templates = [t for t in (Template.of(*x) for x in licenses) if t.words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling = {w for t in templates for w in t.telling}
        for batch in batches:
            rows = []
            for k, body in zip(batch.column(0), batch.column(1)):
                lower = (body.as_py() or "").lower()
                words = _WORD.findall(lower)
                if telling.isdisjoint(words):
                    continue
                found = list(scan_words(words, templates, coverage, density))
                if found:
                    # Lower-casing keeps the number of words, not always that of code points.
                    places = [m.span() for m in _WORD.finditer(body.as_py())]
                    places = places if len(places) == len(words) else [m.span() for m in _WORD.finditer(lower)]
                    rows += [
                        (k.as_py(), t.name, places[a][0], places[b][1], n, n / len(t.words)) for t, a, b, n in found
                    ]
            cols = list(zip(*rows)) or [()] * 6
            types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            names = ["doc_id", "license", "start", "end", "aligned", "coverage"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, SCHEMA)
