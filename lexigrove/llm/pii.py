"""Personal data replaced by surrogates, in DataFrame functions only.

One pattern finds entities; each gets a surrogate of its own kind and format by a keyed permutation of all strings of
that format (a Feistel network that adds, symbol by symbol, a keyed hash of the other half). Digits stay digits, vowels vowels,
capitals capitals, each within its script; a mail address keeps its last label, a phone number its country code, a card
number its check sum, a network address is one again; a name keeps title and ending. Known given names are exchanged for
others of the same gender and script, in a keyed cycle. So nothing must be stored or joined: one value has one surrogate everywhere
(coreference), two values never share one (distinctness), whatever the size of the corpus. The permutation is conjugated
with a step by one, so no value is its own surrogate. ``collisions`` checks this on a corpus.

Defined results: a null text stays null, an empty one empty, a text without entities is unchanged; repeated rows are
treated alike; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 4

#: Given names by gender and script; surrogates come from the same list.
GIVEN_NAMES = {
    "female latin": [
        "Alice", "Anna", "Barbara", "Carla", "Carmen", "Charlotte", "Claire", "Clara", "Elena", "Elizabeth", "Emily", "Emma",
        "Hannah", "Helga", "Ingrid", "Isabelle", "Jane", "Jennifer", "Julia", "Karen", "Laura", "Linda", "Lisa", "Maria",
        "Marie", "Mary", "Monika", "Nancy", "Olivia", "Patricia", "Petra", "Sarah", "Sophie", "Susan", "Teresa", "Ursula",
    ],
    "male latin": [
        "Alexander", "Andreas", "Antonio", "Carlos", "Charles", "Daniel", "David", "Diego", "Edward", "Francisco", "George",
        "Hans", "Henri", "Jack", "Jacques", "James", "Jean", "John", "Jorge", "Klaus", "Louis", "Lukas", "Manuel", "Michael",
        "Miguel", "Oliver", "Pablo", "Patrick", "Paul", "Peter", "Philippe", "Pierre", "Richard", "Robert", "Stefan", "Thomas",
    ],
    "female cyrillic": ["Анна", "Вера", "Галина", "Елена", "Ирина", "Людмила", "Мария", "Наталья", "Ольга", "Татьяна"],
    "male cyrillic": ["Александр", "Борис", "Владимир", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей", "Юрий"],
}
#: Titles after which a name follows.
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra"]
#: Symbols that take each other's place.
ALPHABETS = [
    "0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ", "áéíóú", "äöü", "ÄÖÜ", "èàù",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_GIVEN = "|".join(n for names in GIVEN_NAMES.values() for n in names)
_FAMILY = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])[0-9a-f]{32,}(?![0-9A-Za-z])",
    "name": rf"\b(?:{'|'.join(TITLES)})\.? {_FAMILY}(?: {_FAMILY})?|\b(?:{_GIVEN}) {_FAMILY}",
}
ENTITY = "|".join(PATTERNS.values())


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _permuted(symbols: Column, key: str) -> Column:
    """Keyed permutation without fixed points of an array of ``(x, n)``, 0 <= x < n; ``n`` = 1 stays as it is."""

    def moved(state: Column, step: Column) -> Column:
        sign = F.signum(step).cast("int")
        number = F.abs(step)
        turn = number % 2
        others = F.transform(state, lambda s, i: F.when(i % 2 == turn, F.lit("")).otherwise(s["x"].cast("string")))
        seed = F.sha2(F.concat_ws(":", F.lit(key), number.cast("string"), F.array_join(others, ",")), 256)

        def add(s: Column, i: Column, seed: Column) -> Column:
            gap = F.pmod(F.xxhash64(seed, i), s["n"].cast("long")).cast("int")
            x = F.when(step == 0, s["x"] + 1).when(i % 2 == turn, s["x"] + sign * gap).otherwise(s["x"])
            return F.struct(F.pmod(x, s["n"]).alias("x"), s["n"].alias("n"))

        return _let(seed, lambda seed: F.transform(state, lambda s, i: add(s, i, seed)))

    steps = [*(-r for r in range(ROUNDS, 0, -1)), 0, *range(1, ROUNDS + 1)]
    return F.aggregate(F.array(*(F.lit(s) for s in steps)), symbols, moved)


def _in_format(text: Column, key: str, alphabets: list[str] = ALPHABETS) -> Column:
    """Every symbol replaced by one of its own alphabet; what is in none stays."""
    slot = max(map(len, alphabets))
    letters = F.lit("".join(a.ljust(slot, "\u0000") for a in alphabets))
    widths = F.array(*(F.lit(len(a)) for a in alphabets))
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def symbol(c: Column) -> Column:
        return _let(F.instr(letters, c) - 1, lambda p: F.struct(
            F.when(p < 0, 0).otherwise(p % slot).cast("int").alias("x"),
            F.when(p < 0, 1).otherwise(F.get(widths, F.greatest(F.floor(p / slot).cast("int"), F.lit(0)))).cast("int").alias("n"),
            F.when(p >= 0, F.floor(p / slot).cast("int") * slot).alias("at"),
            c.alias("c"),
        ))

    def spell(symbols: Column) -> Column:
        new = _permuted(F.transform(symbols, lambda s: F.struct(s["x"].alias("x"), s["n"].alias("n"))), key)
        return F.array_join(F.zip_with(symbols, new, lambda s, t: F.when(s["at"].isNull(), s["c"]).otherwise(
            F.substr(letters, s["at"] + t["x"] + 1, F.lit(1)))), "")

    return _let(F.transform(chars, symbol), spell)


def _network_address(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, r"\."), lambda o: F.struct(o.cast("int").alias("x"), F.lit(256).alias("n")))
    return F.array_join(F.transform(_permuted(octets, key), lambda s: s["x"].cast("string")), ".")


def _check_sum(digits: Column) -> Column:
    """Luhn sum of the digits, the last one counted once."""
    def weighed(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = (F.size(digits) - i) % 2 == 0
        return F.when(twice, F.when(n > 4, n * 2 - 9).otherwise(n * 2)).otherwise(n)
    return F.aggregate(F.transform(digits, weighed), F.lit(0), lambda a, b: a + b)


def _card(text: Column, key: str) -> Column:
    """All digits but the last permuted; the last one keeps the check sum's remainder."""
    def digits(t: Column) -> Column:
        return F.filter(F.split(t, ""), lambda c: c.between("0", "9"))

    body = F.substr(text, F.lit(1), F.length(text) - 1)
    return _let(_in_format(body, key), lambda new: F.concat(new, _let(
        _check_sum(digits(text)) - _check_sum(F.concat(digits(new), F.array(F.lit("0")))),
        lambda rest: F.pmod(rest, F.lit(10)).cast("string"))))


def _name_cycle(key: str) -> dict[str, str]:
    """Each known name's successor in its list, which is put in a keyed order."""
    out = {}
    for kind, names in GIVEN_NAMES.items():
        order = sorted(names, key=lambda n: hashlib.sha256(f"{key}:{kind}:{n}".encode()).digest())
        out |= dict(zip(order, [*order[1:], order[0]], strict=True))
    return out


def _name(text: Column, key: str) -> Column:
    """Word by word: titles stay, given names follow the cycle, others keep ending and shape."""
    cycle = _name_cycle(key)
    known = F.create_map(*(F.lit(x) for pair in cycle.items() for x in pair))
    titles = [*TITLES, *(f"{t}." for t in TITLES)]

    def shaped(word: Column) -> Column:
        body = F.substr(word, F.lit(1), F.greatest(F.length(word) - 1, F.lit(1)))
        return F.concat(_in_format(body, key), F.substr(word, F.length(body) + 1))

    def one(word: Column) -> Column:
        again = _let(shaped(word), lambda new: F.when(F.element_at(known, new).isNotNull(), shaped(new)).otherwise(new))
        return F.when(word.isin(titles), word).otherwise(F.coalesce(F.element_at(known, word), again))

    return F.array_join(F.transform(F.split(text, " "), one), " ")


def kind_of(value: Column) -> Column:
    """The kind of an entity, from its form alone, so that each form has one permutation."""
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
        .when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(value.rlike(r"^[0-9]([ -]?[0-9]){12,18}$"), "card")
        .when(value.rlike(r"^[+(0-9][0-9() .-]*$"), "phone")
        .when(value.rlike(r"^[0-9a-f]{32,}$"), "secret")
        .otherwise("name")
    )


def surrogate(value: Column, key: str) -> Column:
    """The surrogate of an entity; a function of the value and the key alone."""
    ending = F.regexp_extract(value, r"\.[A-Za-z]{2,}$", 0)
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?![0-9])", 0)
    return _let(kind_of(value), lambda kind: (
        F.when(kind == "email", F.concat(_in_format(F.substr(value, F.lit(1), F.length(value) - F.length(ending)), key), ending))
        .when(kind == "ip", _network_address(value, key))
        .when(kind == "card", _card(value, key))
        .when(kind == "phone", F.concat(country, _in_format(F.substr(value, F.length(country) + 1), key)))
        .when(kind == "secret", _in_format(value, key, ["0123456789abcdef"]))
        .when(kind == "ssn", _in_format(value, key))
        .otherwise(_name(value, key))
    ))


def replace_entities(docs: DataFrame, key: str, *, text: str = "text", entities: str | None = "entities") -> DataFrame:
    """``docs`` with surrogates in ``text`` and a column ``entities`` of ``(kind, start, length, surrogate)``.

    ``start`` counts characters of the new text from 0. ``entities=None`` leaves that column out.
    """
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(ENTITY), F.lit(0))
    rows = docs.select(F.struct("*").alias("_row"), found.alias("_found"))
    new = F.when(F.size("_found") > 0, F.transform("_found", lambda v: surrogate(v, key)))
    rows = rows.select("_row", "_found", F.coalesce(new, F.array().cast("array<string>")).alias("_new"))
    between = F.when(F.size("_new") > 0, F.split(F.col("_row")[text], ENTITY, -1)).otherwise(F.array(F.col("_row")[text]))
    rows = rows.select("_row", "_found", "_new", between.alias("_between"))
    padded = F.concat("_new", F.array(F.lit("")))
    whole = F.when(F.size("_new") > 0, F.array_join(F.zip_with("_between", padded, lambda a, b: F.concat(a, b)), ""))
    columns = [F.coalesce(whole, F.col("_row")[text]).alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c != entities]
    if entities:
        starts = F.transform("_new", lambda _, i: F.aggregate(
            F.zip_with(F.slice("_between", F.lit(1), i + 1), F.slice(F.concat(F.array(F.lit("")), "_new"), F.lit(1), i + 1),
                       lambda a, b: F.length(a) + F.length(b)), F.lit(0), lambda a, b: a + b))
        columns.append(F.zip_with(F.zip_with("_found", "_new", lambda v, n: F.struct(
            kind_of(v).alias("kind"), F.length(n).alias("length"), n.alias("surrogate"))), starts, lambda e, s: F.struct(
            e["kind"].alias("kind"), s.alias("start"), e["length"].alias("length"), e["surrogate"].alias("surrogate"))).alias(entities))
    return rows.select(*columns)


def collisions(docs: DataFrame, key: str, *, text: str = "text") -> DataFrame:
    """``(surrogate, n)`` of surrogates that more than one value of the corpus got, or a value got itself: none."""
    found = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(ENTITY), F.lit(0))).alias("value")).distinct()
    given = found.select("value", surrogate(F.col("value"), key).alias("surrogate"))
    return given.groupBy("surrogate").agg(F.count("*").alias("n"), F.max((F.col("value") == F.col("surrogate")).cast("int")).alias("same")) \
        .filter("n > 1 or same = 1").select("surrogate", "n")
