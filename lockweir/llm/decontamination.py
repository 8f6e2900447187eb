"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders; what is left is its template. Windows
of template tokens of every document meet those of the benchmark in a hash join. Along one
alignment of a document with an item, the slots are then compared: where the item has one name or unit,
the document must have one too. Texts are tokenised once and read in three ways: a capitalised word at the start
of a sentence as a word, as a name, and all words and numbers as they are but for their case. Values that all agree
make the copy verbatim; values that differ consistently make it a re-parameterised question.

Nearly no document holds a window of the benchmark. Each benchmark window has an anchor, its longest run of three
neighbouring words (or two or one, where there are no more), and only documents with an anchor among their plain words are read in all ways. A plan
holds a bounded number of anchors; for a larger benchmark this step is left out. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.once import once
from ..session import cut

# --- fixed values
NAME_MARK, UNIT_MARK, START_MARK = "", "", ""  # private-use characters
_UNITS = (
    "km cm mm m kg mg g lb lbs oz ml l mph kmh hours hour minutes minute seconds second days day weeks week months "
    "month years year dollars dollar euros euro cents cent percent miles mile meters metres feet foot inches inch "
    "grams kilograms liters litres degrees usd eur gbp"
)
# A word with a single capital (or several such words) is a name. All loops are possessive: the
# matcher then neither goes back nor needs a stack frame for each round, however long a run is.
_WORD = r"\p{L}[\p{L}\p{M}']*+"
_NAME_WORD = r"\p{Lu}\p{Ll}[\p{L}\p{M}']*+"
_NAME_WORDS = rf"{_NAME_WORD}(?: {_NAME_WORD})*+"
_NAME = rf"\p{{Lu}}(?<![\p{{L}}\p{{M}}']\p{{Lu}})\p{{Ll}}[\p{{L}}\p{{M}}']*+(?: {_NAME_WORD})*+"
_AT_START = rf"{NAME_MARK}(?<![\p{{L}}\p{{N}},;:] {NAME_MARK})"  # a name that does not stand within a sentence
_NUMBER = r"\p{Nd}++(?:[.,:/]\p{Nd}++)*+"
_UNIT = rf"(\p{{Nd}})( ?)({'|'.join(_UNITS.split())}|[%°$€£])(?![\p{{L}}\p{{M}}'])"
_TOKEN = rf"[{NAME_MARK}{START_MARK}]{_NAME_WORDS}|{UNIT_MARK}[\p{{L}}%°$€£]++|{_NUMBER}|{_WORD}"

_PLAIN_TOKEN = rf"{_NUMBER}|{_WORD}"

# Anchors (8 bytes each) that a plan holds at most; with more, all documents are read in all ways.
_MOST_ANCHORS = 1 << 16


def _clean(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    marks = (NAME_MARK, UNIT_MARK, START_MARK)
    marked = text.contains(marks[0]) | text.contains(marks[1]) | text.contains(marks[2])
    return F.when(marked, F.translate(text, "".join(marks), "   ")).otherwise(text)


# How a text is read: names within sentences only, names anywhere, or everything as plain words.
WITHIN, ANYWHERE, PLAIN = READINGS = (0, 1, 2)


def marked_tokens(text: Column) -> Column:
    """Words as they stand, numbers, and names and units with their mark; a name that begins a sentence has a mark of its own."""
    named = F.regexp_replace(_clean(text), _NAME, f"{NAME_MARK}$0")
    named = F.regexp_replace(named, _AT_START, START_MARK)
    marked = F.when(named.rlike(r"\p{Nd}"), F.regexp_replace(named, _UNIT, f"$1 {UNIT_MARK}$3")).otherwise(named)
    return F.regexp_extract_all(marked, F.lit(_TOKEN), F.lit(0))


def plain_tokens(text: Column) -> Column:
    """All words and numbers in lower case."""
    return F.regexp_extract_all(F.lower(_clean(text)), F.lit(_PLAIN_TOKEN), F.lit(0))


def _body(token: Column) -> Column:
    return F.substring(token, 2, 1 << 30)


def read_tokens(marked: Column, reading: int) -> Column:
    """The marked tokens with names within sentences only, or anywhere.

    In the first reading, a name that begins a sentence is a word, and a name of what follows it.
    """
    starts = lambda t: F.startswith(t, F.lit(START_MARK))
    if reading == ANYWHERE:
        return F.transform(marked, lambda t: F.when(starts(t), F.concat(F.lit(NAME_MARK), _body(t))).otherwise(t))

    def split(token: Column) -> Column:
        first = F.substring_index(_body(token), " ", 1)
        rest = F.substring(token, F.length(first) + 3, F.length(token))
        return F.when(starts(token) & token.contains(" "), F.array(first, F.concat(F.lit(NAME_MARK), rest))).when(
            starts(token), F.array(first)
        ).otherwise(F.array(token))

    return F.flatten(F.transform(marked, split))


def _placed(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    digit = (first <= "9") | (first > "\x7f") & first.rlike(r"\p{Nd}")
    mark = F.when(first == UNIT_MARK, UNIT_MARK).otherwise(NAME_MARK)
    return F.when(first.isin(NAME_MARK, UNIT_MARK, START_MARK), mark).when(digit, "0").otherwise(F.lower(token))


def template_tokens(tokens: Column) -> Column:
    """Lower-case words, with numbers, names and units replaced by their placeholder; one to one with ``tokens``."""
    return F.transform(tokens, _placed)


def _is_slot(token: Column) -> Column:
    return token.isin("0", NAME_MARK, UNIT_MARK)


def _run(tokens: Column, at: Column, words: int) -> Column:
    return F.xxhash64(*(F.get(tokens, at + k) for k in range(words)))


def _anchor(tokens: Column, reading: Column) -> Column:
    """``words, size, number`` of a window's anchor: of its runs of three, or else two, or else one, words the longest.

    Words that are neighbours in a template are so in the plain text.
    """
    is_word = F.transform(tokens, lambda t: ~_is_slot(t) | (reading == PLAIN))

    def runs(words: int) -> Column:
        at = F.sequence(F.lit(0), F.size(tokens) - 1)
        all_words = lambda i: F.forall(F.slice(is_word, i + 1, words), lambda x: x) & (i <= F.size(tokens) - words)
        size = lambda i: F.length(F.array_join(F.slice(tokens, i + 1, words), ""))
        return F.transform(F.filter(at, all_words), lambda i: F.struct(F.lit(words).alias("words"), size(i).alias("size"), _run(tokens, i, words).alias("number")))

    return F.array_max(F.concat(*(runs(words) for words in (1, 2, 3))))


def _anchored(plain: Column, anchors: dict[int, list[int]]) -> Column:
    """Whether a text holds an anchor of the benchmark; with too many of them, all texts may."""
    if sum(map(len, anchors.values())) > _MOST_ANCHORS:
        return F.lit(True)
    found = F.lit(False)
    for words, numbers in sorted(anchors.items()):
        at = F.sequence(F.lit(0), F.greatest(F.size(plain) - words, F.lit(0)))
        found = found | F.exists(at, lambda i: _run(plain, i, words).isin(numbers))
    return found


def _windows(tokens: Column, reading: int, size: int) -> Column:
    """``reading, size, pos, hash`` of all windows; only a document of one word holds an item of one word."""
    row = lambda i: F.struct(
        F.lit(reading).alias("reading"), F.lit(size).alias("size"), i.alias("pos"), F.xxhash64(F.slice(tokens, i + 1, size)).alias("hash")
    )
    last = F.size(tokens) - size
    fits = (last == 0) if size == 1 else (last >= 0)
    return F.when(fits, F.transform(F.sequence(F.lit(0), last), row)).otherwise(F.array().cast("array<struct<reading:int,size:int,pos:int,hash:bigint>>"))


def read_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, reading, item, template``: the tokens of each item in each reading, and their template."""
    items = once(benchmark, marked=marked_tokens(F.col("text"))).select("item_id", F.explode(_read("item")).alias("r"))
    return items.select("item_id", "r.*").withColumn("template", _template(F.col("item"))).filter(F.size("item") > 0)


def _read(name: str) -> Column:
    """From ``text`` and ``marked``, the tokens of all readings."""
    tokens = lambda r: plain_tokens(F.col("text")) if r == PLAIN else read_tokens(F.col("marked"), r)
    return F.array(*(F.struct(F.lit(r).alias("reading"), tokens(r).alias(name)) for r in READINGS))


def _template(tokens: Column) -> Column:
    return F.when(F.col("reading") == PLAIN, tokens).otherwise(template_tokens(tokens))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``hash, size, item_id, reading, at, n_windows, anchor`` for each window of each item in each reading.

    Windows of which fewer than half the tokens are words are left out, unless an item has no other; those
    without a word always are.
    An item shorter than ``window`` is one window of its own size.
    """
    tokens = F.col("template")
    items = items.withColumn("size", F.least(F.size(tokens), F.lit(window)))
    starts = F.sequence(F.lit(0), F.size(tokens) - F.col("size"))
    words = lambda i: F.size(F.filter(F.slice(tokens, i + 1, F.col("size")), lambda t: ~_is_slot(t) | (F.col("reading") == PLAIN)))
    rich = F.filter(starts, lambda i: 2 * words(i) >= F.col("size"))
    items = items.withColumn("starts", F.when(F.size(rich) > 0, rich).otherwise(F.filter(starts, lambda i: words(i) > 0)))
    each = items.select("item_id", "reading", tokens, "size", F.size("starts").alias("n_windows"), F.explode("starts").alias("at"))
    window_tokens = F.slice(tokens, F.col("at") + 1, F.col("size"))
    return each.select(
        F.xxhash64(window_tokens).alias("hash"), "size", "item_id", "reading", "at", "n_windows", _anchor(window_tokens, F.col("reading")).alias("anchor")
    )


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 8,
    least_windows: int = 6,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents that hold benchmark items, as ``doc_id, item_id, text_key`` and what was found.

    A document holds an item if at least ``least_windows`` distinct windows of it (all, if it has
    fewer) match along one alignment of one reading, token by token, and the names and units there are consistent:
    where the item has one name, the document has one name, word by word. Numbers may differ as they like, as two
    of an item can be equal by chance. The further columns tell of
    the best alignment of the first reading that has one: ``at`` (first matched token of the item), ``tokens`` (aligned length),
    ``windows``, ``coverage`` (of the item's windows), ``slots`` and ``verbatim``. ``text_key`` is
    the MD5 of the text.

    Null texts hold nothing, null ids are told as null; texts of any length are read as a whole; repeated documents
    are told once per distinct id; repeated items once. Items without tokens match nothing, an item of one
    word only a document of one word; empty tables give no rows; other columns are ignored.
    """
    benchmark = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    items = cut(read_items(benchmark))
    windows = cut(item_windows(items, window))
    # at most `window` numbers for each reading
    sizes = sorted((r["reading"], r["size"]) for r in windows.select("reading", "size").distinct().collect())
    # Of the windows that an alignment needs, all but one may be without an anchor: those with the shortest ones.
    spare = F.least(F.lit(least_windows), F.col("n_windows")) - 1
    order = Window.partitionBy("item_id", "reading").orderBy("anchor.words", "anchor.size", "at")
    wanted = windows.withColumn("place", F.row_number().over(order)).filter(F.col("place") > spare)
    anchors: dict[int, list[int]] = {}
    for r in wanted.select("anchor.words", "anchor.number").distinct().limit(_MOST_ANCHORS + 1).collect():
        anchors.setdefault(r["words"], []).append(r["number"])
    own = once(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), plain=plain_tokens(F.col("text")))
    own = cut(own.filter(_anchored(F.col("plain"), anchors)).select("doc_id", "text", text_key(F.col("text")).alias("text_key")))
    names = {WITHIN: "within", ANYWHERE: "anywhere", PLAIN: "plain"}
    read = once(
        once(own.select("text_key", "text"), marked=marked_tokens(F.col("text"))), plain=plain_tokens(F.col("text")),
        within=template_tokens(read_tokens(F.col("marked"), WITHIN)), anywhere=template_tokens(F.col("marked")),
    )
    told = F.concat(
        F.array().cast("array<struct<reading:int,size:int,pos:int,hash:bigint>>"),
        *(_windows(F.col(names[reading]), reading, size) for reading, size in sizes),
    )
    met = read.select("text_key", F.explode(told).alias("w")).select("text_key", "w.*").join(windows.drop("anchor"), ["hash", "reading", "size"])
    shift = F.col("pos") - F.col("at")
    aligned = cut(
        met.groupBy("text_key", "item_id", "reading", "size", "n_windows", shift.alias("shift"))
        .agg(F.collect_set("at").alias("ats"))
        .filter(F.size("ats") >= F.least(F.lit(least_windows), "n_windows"))
    )
    keys = aligned.select("text_key").distinct()
    texts = once(own.join(keys, "text_key").distinct(), marked=marked_tokens(F.col("text")))
    read = texts.select("doc_id", "text_key", F.explode(_read("doc")).alias("r")).select("doc_id", "text_key", "r.*")
    held = read.join(aligned, ["text_key", "reading"]).withColumn("doc_template", _template(F.col("doc"))).join(items, ["item_id", "reading"])
    # What a hash has found is compared once token by token.
    same = lambda a: F.slice("template", a + 1, F.col("size")) == F.slice("doc_template", a + F.col("shift") + 1, F.col("size"))
    held = held.withColumn("ats", F.filter("ats", same)).filter(F.size("ats") >= F.least(F.lit(least_windows), "n_windows"))
    held = held.withColumn("at", F.array_min("ats")).withColumn("n", F.array_max("ats") + F.col("size") - F.col("at"))
    side = lambda c, start: F.slice(c, F.greatest(start, F.lit(0)) + 1, F.col("n"))
    zipped = F.zip_with(
        F.zip_with(side("item", F.col("at")), side("template", F.col("at")), lambda a, t: F.struct(a.alias("a"), t.alias("t"))),
        side("doc", F.col("at") + F.col("shift")),
        lambda x, b: F.struct(x["a"].alias("a"), x["t"].alias("t"), b.alias("b")),
    )
    pairs = F.array_distinct(F.filter(zipped, lambda z: _is_slot(z["t"]) & (F.col("reading") != PLAIN)))
    words = lambda c: F.split(c, " ")
    alike = lambda p: F.size(words(p["a"])) == F.size(words(p["b"]))
    word_by_word = lambda p: F.when(
        alike(p), F.zip_with(words(p["a"]), words(p["b"]), lambda a, b: F.struct(F.ltrim(a, F.lit(NAME_MARK)).alias("a"), F.ltrim(b, F.lit(NAME_MARK)).alias("b")))
    ).otherwise(F.array(F.struct(p["a"], p["b"])))
    bound = F.array_distinct(F.flatten(F.transform(F.filter("pairs", lambda p: p["t"] != "0"), word_by_word)))
    judged = held.withColumn("pairs", pairs).withColumn("bound", bound)
    consistent = F.size(F.array_distinct(F.transform("bound", lambda p: p["a"]))) == F.size("bound")
    found = judged.filter(consistent).select(
        "doc_id",
        "item_id",
        "text_key",
        F.struct(
            (-F.col("reading")).alias("reading"),
            F.size("ats").cast("long").alias("windows"),
            (-F.col("shift")).alias("order"),
            F.col("at"),
            F.col("n").alias("tokens"),
            F.round(F.size("ats") / F.col("n_windows"), 6).alias("coverage"),
            F.size("pairs").alias("slots"),
            F.forall("pairs", lambda p: p["a"].eqNullSafe(p["b"])).alias("verbatim"),
        ).alias("best"),
    )
    best = found.groupBy("doc_id", "item_id", "text_key").agg(F.max("best").alias("best"))
    return best.select(
        "doc_id", "item_id", "text_key", *[F.col(f"best.{c}").alias(c) for c in ("at", "tokens", "windows", "coverage", "slots", "verbatim")]
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are."""
    bad = contaminated(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text")), benchmark, **options)
    bad = cut(bad.select(F.col("text_key").alias("_lockweir_key")).distinct())
    return docs.join(bad, text_key(docs[text]) == bad["_lockweir_key"], "left_anti")
