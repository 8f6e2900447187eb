"""Personal data replaced by keyed surrogates of the same type and form.

A surrogate is a function of a secret key, the type and the canonical value, so an entity gets the
same one wherever it occurs, in any spelling of its separators or case. Given names go to names of
the same gender and script, letters to letters of their script and case, digits to digits; card
numbers and IBANs keep the validity of their check digits, addresses of one mail domain share a
domain. Distinct values must get distinct surrogates that are not themselves values of the corpus:
all distinct values are checked for that, and the few that fail draw again until none does. Only
built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import is_iban, is_luhn
from ..session import cut


# --- fixed values: names by gender and script, and the names that stand in for them, one for each.
@dataclass(frozen=True)
class Names:
    known: str
    stand_in: str


FEMALE = Names(
    "Mary Anna Emma Olivia Sophia Maria Laura Julia Sarah Linda Susan Karen Alice Carla Dora Jane Elena Marta Claire Camille",
    "Wilma Brenda Hilda Ingrid Selma Thelma Norma Edith Agnes Mabel Gilda Ramona Odette Yvonne Ursula Petra Bettina Corinne Lucinda Rosalind",
)
MALE = Names(
    "John James Robert Michael David William Richard Thomas Peter Paul Mark Daniel Carlos Pedro Hans Jean Pierre Bob Adam Henry",
    "Wilbur Horace Cedric Alvin Virgil Rupert Clyde Elmer Osmond Gilbert Roland Ernst Fabian Ignacio Ulrich Marcel Lucien Desmond Barnaby Quentin",
)
FEMALE_CYRILLIC = Names("Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана", "Зинаида Клавдия Раиса Тамара Фаина Римма Нонна Инесса")
MALE_CYRILLIC = Names("Иван Сергей Алексей Дмитрий Андрей Николай Михаил Павел", "Фёдор Тимофей Савелий Прохор Никифор Лаврентий Ефим Демьян")
NAMES = (FEMALE, MALE, FEMALE_CYRILLIC, MALE_CYRILLIC)
_SYLLABLES = "bar del fen gol har kin lor mar nel par quin ros sal tor ven wil".split()
_SYLLABLES_CYRILLIC = "бар вол гор дон жар зим кос лен мир ник пет рад сол тор фед чер".split()

# --- fixed values: the forms of entities, most specific first.
_GIVEN = "|".join(n for names in NAMES for n in names.known.split())
_SURNAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
_NAME = rf"(?<!\p{{L}})(?:{_GIVEN})(?: {_SURNAME})?(?!\p{{L}})"
FORMS = {
    # Bounded and possessive: a long run without a blank is read once, and loops need no stack. What stands
    # before the @ has 256 characters at most, and of a longer domain the first twelve labels are taken.
    "EMAIL": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,256}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+){1,12}+",
    "TOKEN": r"(?<![\p{L}\p{N}])[0-9A-Fa-f]{32,128}(?![\p{L}\p{N}])",
    "ACCESS_KEY": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9]{20,}+)(?![\p{L}\p{N}])",
    "IBAN": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "IP": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "CARD": r"(?<![\p{L}\p{N}])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\p{L}\p{N}])",
    "SSN": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "PHONE": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![\p{L}\p{N}.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "NAME": _NAME,
}
_ANY = "|".join(FORMS.values())

_CYRILLIC = "^[\\u0400-\\u04ff]"

MAX_ROUNDS = 50


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _may_hold(text: Column) -> Column:
    """A cheap test that any entity implies."""
    return text.rlike("[0-9@]") & text.rlike("|".join(v for k, v in FORMS.items() if k != "NAME")) | text.rlike(_NAME)


def _kind(e: Column) -> Column:
    chain = None
    for kind, form in FORMS.items():
        # Most forms look at their surroundings; inside a match these are the ends of the string.
        test = e.rlike(f"^(?:{form})$")
        chain = F.when(test, kind) if chain is None else chain.when(test, kind)
    return chain


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, "[^0-9]", "")


def _canonical(e: Column, kind: Column) -> Column:
    """What identifies the entity: case and separators that do not matter are gone.

    Of a name it is the surname, empty if there is none; a phone number keeps its country code apart.
    """
    cc = F.regexp_extract(e, r"^\+(1|7|[0-9]{2})", 1)  # the same with and without separators
    return (
        F.when(kind.isin("EMAIL", "TOKEN"), F.lower(e))
        .when(kind == "IBAN", F.replace(e, F.lit(" "), F.lit("")))
        .when(kind.isin("CARD", "SSN"), _digits(e))
        .when(kind == "NAME", F.regexp_extract(e, f" ({_SURNAME})$", 1))
        .when((kind == "PHONE") & (cc != ""), F.concat(cc, F.lit("|"), F.substring(_digits(e), F.length(cc) + 1, F.length(e))))
        .when(kind == "PHONE", _digits(e))
        .otherwise(e)
    )


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """Hexadecimal digits, two for each character of the value and more."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(value) / 60).cast("int"))
    seed = lambda b: F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), b.cast("string"), value)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(seed(b), 512)), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _letter(c: Column, byte: Column) -> Column:
    """Another character of the same class, script and case."""
    cyrillic = F.element_at(F.split(F.lit("абвгдежзиклмнопрстуфхцчшщыэюя"), ""), byte % 29 + 1)
    low = F.when(c.rlike(_CYRILLIC), cyrillic).otherwise(F.char(F.lit(97) + byte % 26))
    return (
        F.when(c.rlike("^[0-9]"), (byte % 10).cast("string"))
        .when(c.rlike(r"^\p{Lu}"), F.upper(low))
        .when(c.rlike(r"^\p{L}"), low)
        .otherwise(c)
    )


def _like(value: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: _letter(c, _byte(stream, i))), "")


def _luhn_digit(body: Column) -> Column:
    """The digit that makes ``body`` pass the Luhn test."""
    weighed = F.transform(
        F.split(F.reverse(body), ""),
        lambda c, i: F.when(i % 2 == 1, c.cast("int")).when(c.cast("int") < 5, c.cast("int") * 2).otherwise(c.cast("int") * 2 - 9),
    )
    return (10 - F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10) % 10


def _iban_digits(country: Column, body: Column) -> Column:
    turned = F.concat(body, country, F.lit("00"))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + c.try_cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97),
    )
    return F.lpad((98 - rest).cast("string"), 2, "0")


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The stand-in of a canonical value, itself canonical, in a draw that ``attempt`` numbers."""
    return _let(_stream(key, kind, value, attempt), lambda h: _surrogate(kind, value, attempt, key, h))


def _surrogate(kind: Column, value: Column, attempt: Column, key: str, h: Column) -> Column:
    domain = F.regexp_extract(value, r"@(.*)\.[^.]*$", 1)
    email = F.concat(
        _like(F.substring_index(value, "@", 1), h), F.lit("@"),
        _let(_stream(key, F.lit("DOMAIN"), domain, F.lit(0)), lambda d: _like(domain, d)),
        F.lit("."), F.substring_index(value, ".", -1),
    )
    body = F.concat(F.substring(value, 1, 1), _like(F.substring(value, F.lit(2), F.length(value) - 2), F.substring(h, F.lit(3), F.length(h))))
    check = _luhn_digit(body)
    card = F.concat(body, F.when(is_luhn(value), check).otherwise((check + 1 + _byte(h, F.lit(0)) % 9) % 10).cast("string"))
    country, rest = F.substring(value, 1, 2), _like(F.substring(value, F.lit(5), F.length(value)), h)
    iban = F.concat(country, F.when(is_iban(value), _iban_digits(country, rest)).otherwise(_like(F.substring(value, 3, 2), h)), rest)
    ip = F.concat_ws(".", *[(_byte(h, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    prefix = F.regexp_extract(value, "^(AKIA|gh._|sk-)", 1)
    access = F.concat(prefix, _like(F.substring(value, F.length(prefix) + 1, F.length(value)), h))
    plus = value.contains("|")
    phone = F.when(
        plus, F.concat(F.substring_index(value, "|", 1), F.lit("|"), _like(F.substring_index(value, "|", -1), h))
    ).otherwise(_like(value, h))
    part = lambda names, i: F.element_at(F.array(*map(F.lit, names)), _byte(h, i) % len(names) + 1)
    # Each further draw is a syllable longer, so there are always names left.
    sound = lambda names: F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: part(names, i)), ""))
    surname = F.when(value.rlike(_CYRILLIC), sound(_SYLLABLES_CYRILLIC)).otherwise(sound(_SYLLABLES))
    return (
        F.when(kind == "EMAIL", email)
        .when(kind == "TOKEN", F.substring(h, F.lit(1), F.length(value)))
        .when(kind == "ACCESS_KEY", access)
        .when(kind == "IBAN", iban)
        .when(kind == "IP", ip)
        .when(kind == "CARD", card)
        .when(kind == "SSN", F.concat(F.lit("9"), _like(F.substring(value, F.lit(2), F.length(value)), h)))
        .when(kind == "PHONE", phone)
        .when(value != "", surname)
        .otherwise("")
    )


def _shaped(e: Column, kind: Column, s: Column, key: str) -> Column:
    """The stand-in in the form of this occurrence."""
    numbers = F.split(_digits(s), "")
    gaps = F.split(e, "[0-9]", -1)
    spread = F.array_join(F.transform(F.arrays_zip(gaps.alias("gap"), numbers.alias("d")), lambda z: F.concat(z["gap"], F.coalesce(z["d"], F.lit("")))), "")
    letters = F.array_join(
        F.zip_with(F.split(e, ""), F.split(s, ""), lambda a, b: F.when(a.rlike(r"^\p{Lu}"), F.upper(b)).otherwise(b)), ""
    )
    token = F.when(e.rlike("[A-F]") & ~e.rlike("[a-f]"), F.upper(s)).otherwise(s)
    iban = F.when(e.contains(" "), F.trim(F.regexp_replace(s, "(.{4})", "$1 "))).otherwise(s)
    first = F.regexp_extract(e, r"^(\p{L}+)", 1)
    given = F.lit(None).cast("string")
    for names in NAMES:
        known, stand_in = names.known.split(), names.stand_in.split()
        at = F.array_position(F.array(*map(F.lit, known)), first)
        shift = _byte(F.sha2(F.lit(f"{key}\x1f{known[0]}"), 256), F.lit(0))
        pick = F.element_at(F.array(*map(F.lit, stand_in)), ((at + shift) % len(stand_in) + 1).cast("int"))
        given = F.coalesce(given, F.when(at > 0, pick))
    name = F.concat(given, F.when(s != "", F.concat(F.lit(" "), s)).otherwise(""))
    return (
        F.when(kind.isin("CARD", "SSN", "PHONE"), spread)
        .when(kind == "EMAIL", letters)
        .when(kind == "TOKEN", token)
        .when(kind == "IBAN", iban)
        .when(kind == "NAME", name)
        .otherwise(s)
    )


def find(text: Column) -> Column:
    """The entities of a text in order, as ``(e, kind, value)``."""
    found = F.transform(F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)), lambda e: F.struct(e.alias("e"), _kind(e).alias("kind")))
    return F.transform(
        found, lambda x: F.struct(x["e"].alias("e"), x["kind"].alias("kind"), _canonical(x["e"], x["kind"]).alias("value"))
    )


def distinct_values(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind, value`` of all entities of a corpus, once each; a name without surname has no value."""
    return (
        docs.select(F.col(text).alias("text")).filter(_may_hold(F.col("text")))
        .select(F.explode(find(F.col("text"))).alias("x")).select("x.kind", "x.value")
        .filter("value <> ''").distinct()
    )


def redrawn(values: DataFrame, key: str) -> DataFrame:
    """``kind, value, attempt`` of the values that cannot keep their first draw.

    A draw fails if it is a value of the corpus, if a value that is settled already has it, or if a
    smaller value draws it in the same round.
    """
    values = cut(values)
    drawn = lambda df, n: df.select("kind", "value", surrogate(F.col("kind"), F.col("value"), F.lit(n), key).alias("s"))
    own = values.select("kind", F.col("value").alias("s"))
    open_, taken, out, n = values, None, [], 0
    while True:
        now = cut(drawn(open_, n))
        first = now.groupBy("kind", "s").agg(F.min("value").alias("value"))
        good = first.join(own, ["kind", "s"], "left_anti")
        good = good if taken is None else good.join(taken, ["kind", "s"], "left_anti")
        failed = cut(now.join(good, ["kind", "s", "value"], "left_anti").select("kind", "value"))
        if n:
            out.append(good.select("kind", "value", F.lit(n).alias("attempt")))
        if failed.isEmpty():
            break
        taken = good.select("kind", "s") if taken is None else taken.unionByName(good.select("kind", "s"))
        open_, n = failed, n + 1
        if n > MAX_ROUNDS:
            raise ValueError("some type has more values than its form allows stand-ins")
    if not out:
        return values.limit(0).select("kind", "value", F.lit(0).alias("attempt"))
    done = out[0]
    for more in out[1:]:
        done = done.unionByName(more)
    return cut(done)


def _rewritten(text: Column, found: Column, attempts: Column | None, key: str) -> Column:
    drawn = lambda x: F.lit(0) if attempts is None else F.coalesce(
        F.try_element_at(attempts, F.concat_ws("|", x["kind"], x["value"])), F.lit(0)
    )
    new = F.transform(found, lambda x: _shaped(x["e"], x["kind"], surrogate(x["kind"], x["value"], drawn(x), key), key))
    pieces = F.zip_with(F.split(text, _ANY, -1), new, lambda gap, s: F.concat(gap, F.coalesce(s, F.lit(""))))
    return F.array_join(pieces, "")


def anonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """Replace the entities of each whole text; with ``count``, add how many there were.

    Other columns stay as they are (one named like ``count`` is replaced). Null texts stay null and
    empty ones empty, with no entities; repeated rows come out alike; an empty table gives no rows.
    Ids play no part. A surname on its own is not an entity.
    """
    columns = [c for c in docs.columns if c != count]
    docs = docs.select(*columns)
    again = redrawn(distinct_values(docs, text), key)
    holds = F.coalesce(_may_hold(F.col(text)), F.lit(False))
    extra = lambda n: [n.alias(count)] if count else []
    added = [c for c in columns if c != text]

    def out(df, found, attempts):
        new = _rewritten(F.col(text), found, attempts, key).alias(text)
        return df.select(*[new if c == text else F.col(c) for c in columns], *extra(F.size(found)))

    plain = docs.filter(~holds).select(*columns, *extra(F.lit(0)))
    held = docs.filter(holds)
    if again.isEmpty():
        found = held.withColumn("_lockweir_found", find(F.col(text)))
        return out(found, F.col("_lockweir_found"), None).unionByName(plain)
    text_key = F.md5(F.col(text))
    entries = held.select(text_key.alias("_lockweir_key"), F.explode(find(F.col(text))).alias("x")).select(
        "_lockweir_key", "x.kind", "x.value"
    ).distinct()
    attempts = entries.join(again, ["kind", "value"]).groupBy("_lockweir_key").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "value"), "attempt"))).alias("_lockweir_attempts")
    )
    joined = (
        held.withColumn("_lockweir_key", text_key).join(attempts, "_lockweir_key", "left")
        .withColumn("_lockweir_found", find(F.col(text)))
    )
    return out(joined, F.col("_lockweir_found"), F.col("_lockweir_attempts")).unionByName(plain)
