"""Benchmark decontamination by templates, in DataFrame functions only.

A text becomes words (runs of letters or of digits). Numbers, names (capitalised words inside a sentence) and units
(known words after a number) become typed placeholders, so a question asked again with other values has the same
template. Windows of ``window`` template words are hashed and joined with the windows of the benchmark, which are
broadcast if they are few enough and shuffled otherwise. Matched windows with one distance between both positions form
an alignment; its slots must be consistent: each value of the item is replaced by one value throughout. A document
contains an item if consistent alignments cover ``coverage`` of the item's windows.

A capitalised word that begins a sentence or follows a bracket, quote or line break can be a name or a plain word. What the plain
reading doesn't find is looked for with windows of both readings; then the windows that are usable with all such words as
names are those that must be covered, and the slots decide.

Windows with fewer than ``min_plain`` words that are no placeholder are not used on either side. An item left without a window, being
short or mostly numbers, is contained in a text that is that item as a whole: with the same template and consistent
slots, or with the very same values if it is nothing but placeholders. Such a match counts as one window.

Defined results: null texts and texts without a word match nothing. Repeated documents are judged alike, and repeated
items each on their own. Columns other than the named ones are ignored here and passed through by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigrove.plans.runtime import broadcast_if_small, materialize

WINDOW, COVERAGE, MIN_PLAIN = 5, 0.8, 3
#: Windows of the benchmark that may be broadcast: 24 bytes each, 12 MB in all.
BROADCAST_WINDOWS = 500_000

#: Words that are a unit after a number.
UNITS = [
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "cl", "l", "s", "ms", "min", "h", "d", "km2", "m2",
    "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "ounce", "ounces", "pound", "pounds",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "meter", "meters", "metre", "metres", "liter", "liters", "litre", "litres", "gram", "grams",
    "percent", "degrees", "dollar", "dollars", "euro", "euros", "cent", "cents", "usd", "eur", "w", "kw", "v", "a", "hz",
]

_NAME_MARK, _START_MARK = "\u0001", "\u0002"
_NUMBER, _UNIT, _NAME = "<number>", "<unit>", "<name>"
PLACEHOLDERS = [_NUMBER, _UNIT, _NAME]
_IN_SENTENCE = r"([\p{L}0-9,;:] )(\p{Lu}\p{Ll})"
_AT_START = rf"(?<![\p{{L}}{_NAME_MARK}])(\p{{Lu}}\p{{Ll}})"
_WORDS = _NAME_MARK + r"?\p{L}+|[0-9]+"
_ALL_WORDS = rf"[{_NAME_MARK}{_START_MARK}]?\p{{L}}+|[0-9]+"


def words(text: Column, all_names: bool = False) -> Column:
    """Words in order; a word that stands for a name keeps a mark in front, with ``all_names`` every capitalised word."""
    marked = F.regexp_replace(text, _IN_SENTENCE, "$1" + _NAME_MARK + "$2")
    if all_names:
        marked = F.regexp_replace(marked, _AT_START, _START_MARK + "$1")
    return F.regexp_extract_all(marked, F.lit(_ALL_WORDS if all_names else _WORDS), F.lit(0))


def _is_number(word: Column) -> Column:
    return F.ascii(word).between(48, 57)


def templates(words_column: Column) -> Column:
    """Each word or its placeholder."""

    def one(word: Column, i: Column) -> Column:
        low = F.lower(word)
        after_number = (i > 0) & _is_number(F.get(words_column, F.greatest(i - 1, F.lit(0))))
        return (
            F.when(_is_number(word), _NUMBER)
            .when(word.startswith(_NAME_MARK) | word.startswith(_START_MARK), _NAME)
            .when(low.isin(UNITS) & after_number, _UNIT)
            .otherwise(low)
        )

    return F.transform(words_column, one)


def _windows(rows: DataFrame, keys: list[str], text: str, window: int, min_plain: int, all_names: bool = False) -> DataFrame:
    """``(*keys, pos, hash, slots, at_start)`` per window; ``slots`` holds the lower-case word where a placeholder stands, else null.

    ``at_start`` tells whether a slot is a name only because of ``all_names``.
    """
    named = rows.select(*keys, words(F.col(text), all_names).alias("words"))
    named = named.select(*keys, "words", templates(F.col("words")).alias("template"))
    coded = named.select(
        *keys,
        F.transform("template", lambda t: F.xxhash64(t)).alias("codes"),
        F.transform(
            "template", lambda t, i: F.when(t.isin(PLACEHOLDERS), F.translate(F.lower(F.get("words", i)), _START_MARK, _NAME_MARK))
            if all_names else F.when(t.isin(PLACEHOLDERS), F.lower(F.get("words", i)))
        ).alias("slot_words"),
        (F.transform("words", lambda w: w.startswith(_START_MARK)) if all_names else F.array().cast("array<boolean>")).alias("starts"),
    )
    starts = F.slice("codes", F.lit(1), F.greatest(F.size("codes") - (window - 1), F.lit(0)))
    placed = coded.select(*keys, "codes", "slot_words", "starts", F.posexplode(starts).alias("pos", "code"))
    # no lambdas from here on: they would end the generated code, which then holds all windows of a text with its arrays
    slots = [F.get("slot_words", F.col("pos") + k) for k in range(window)]
    plain = sum((s.isNull().cast("int") for s in slots[1:]), slots[0].isNull().cast("int"))
    codes = ["code", *(F.get("codes", F.col("pos") + k) for k in range(1, window))]
    at_start = F.lit(False)
    for k in range(window if all_names else 0):
        at_start = at_start | F.get("starts", F.col("pos") + k)
    kept = placed.filter(plain >= min_plain) if min_plain else placed
    return kept.select(*keys, "pos", F.xxhash64(*codes).alias("hash"), F.array(*slots).alias("slots"), at_start.alias("at_start"))


def _whole(rows: DataFrame, keys: list[str], text: str, most: int | None = None) -> DataFrame:
    """``(*keys, hash, n_words, slots, plain)`` of texts with a word, and at most ``most`` of them, as one window each."""
    some = rows.filter(F.regexp_count(F.col(text), F.lit(_WORDS)).between(1, most or 2**31 - 1))
    named = some.select(*keys, words(F.col(text)).alias("words"))
    named = named.select(*keys, "words", templates(F.col("words")).alias("template"))
    return named.select(
        *keys, F.xxhash64("template").alias("hash"), F.size("words").alias("n_words"),
        F.transform("template", lambda t, i: F.when(t.isin(PLACEHOLDERS), F.lower(F.get("words", i)))).alias("slots"),
        F.size(F.filter("template", lambda t: ~t.isin(PLACEHOLDERS))).alias("plain"),
    )


def _whole_matches(ours: DataFrame, items: DataFrame, with_windows: DataFrame) -> DataFrame | None:
    """Texts that are an item without windows; none asks for a second reading of the documents."""
    kept = _whole(items, ["item_id", "item_text"], "item_text").select(
        F.struct("item_id", F.xxhash64("item_text").alias("text")).alias("item"), "hash", "n_words", F.col("slots").alias("item_slots"), "plain")
    short = broadcast_if_small(kept.join(with_windows, "item", "left_anti"), BROADCAST_WINDOWS)
    most = short.agg(F.max("n_words")).first()[0]
    if most is None:
        return None
    met = _whole(ours, ["doc_id", "text_hash"], "doc_text", most).drop("plain", "n_words").join(short, "hash")
    pairs = F.array_distinct(F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"].isNotNull()))
    met = met.select("doc_id", "text_hash", "item", "plain", pairs.alias("pairs"))
    values = F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))
    changed = F.size(F.filter("pairs", lambda p: p["item_slots"] != p["slots"])).cast("long")
    found = met.filter((F.size(values) == F.size("pairs")) & ((F.col("plain") > 0) | (changed == 0)))
    one = F.lit(1).cast("long")
    return found.select("doc_id", "text_hash", F.col("item")["item_id"].alias("item_id"), one.alias("windows"), one.alias("item_windows"),
                        F.lit(1.0).alias("coverage"), changed.alias("slots_changed"), "item").distinct().drop("item")


def matches(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE, min_plain: int = MIN_PLAIN,
) -> DataFrame:
    """``(doc_id, text_hash, item_id, windows, item_windows, coverage, slots_changed)``, a row per document and item it contains.

    ``slots_changed`` counts the slots with another value than the item's; 0 is a verbatim copy. Stores the windows
    of the benchmark and those that documents share with it when called.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text")).distinct()

    def of_items(all_names: bool) -> DataFrame:
        read = _windows(items, ["item_id", "item_text"], "item_text", window, min_plain, all_names)
        return read.select(
            F.struct("item_id", F.xxhash64("item_text").alias("text")).alias("item"), F.col("pos").alias("item_pos"), "hash",
            F.col("slots").alias("item_slots"), F.lit(not all_names).alias("item_plain"),
        )

    named = of_items(True)
    usable = named.select("item", "item_pos").distinct().withColumn("usable", F.lit(True))
    both_readings = of_items(False).unionByName(named).groupBy("item", "item_pos", "hash", "item_slots").agg(F.max("item_plain").alias("item_plain"))
    usable = usable.select(F.col("item").alias("_item"), F.col("item_pos").alias("_pos"), "usable")
    same = F.col("item").eqNullSafe(F.col("_item")) & (F.col("item_pos") == F.col("_pos"))
    asked = both_readings.join(usable, same, "left").select(*both_readings.columns, F.coalesce("usable", F.lit(False)).alias("usable"))
    asked = broadcast_if_small(asked, BROADCAST_WINDOWS)
    sizes = materialize(asked.groupBy("item").agg(
        F.count(F.when(F.col("item_plain"), 1)).alias("plain_windows"), F.count_distinct(F.when(F.col("usable"), F.col("item_pos"))).alias("usable_windows"),
    ))
    ours = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("doc_text"))
    ours = ours.select("doc_id", "doc_text", F.xxhash64("doc_text").alias("text_hash"))
    keys = ["doc_id", "text_hash"]
    read = _windows(ours, keys, "doc_text", window, min_plain)
    read = read.unionByName(_windows(ours, keys, "doc_text", window, min_plain, True).filter("at_start"))
    both = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"].isNotNull())
    met = read.join(asked, "hash").select(
        *keys, "item", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), both.alias("slots"), "usable",
        (F.col("item_plain") & ~F.col("at_start")).alias("plain"),
    )
    met = materialize(met)

    def found(rows: DataFrame, reading: int, total: str) -> DataFrame:
        aligned = rows.groupBy(*keys, "item", "shift").agg(
            F.collect_set("item_pos").alias("covered"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")
        )
        asked_values = F.array_distinct(F.transform("slots", lambda p: p["item_slots"]))
        consistent = aligned.filter(F.size(asked_values) == F.size("slots"))
        changed = F.size(F.filter("slots", lambda p: p["item_slots"] != p["slots"]))
        counted = consistent.groupBy(*keys, "item").agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).cast("long").alias("windows"),
            F.min(F.struct(-F.size("covered"), changed.cast("long").alias("changed")))["changed"].alias("slots_changed"),
        )
        joined = counted.join(F.broadcast(sizes) if few else sizes, "item").withColumn("item_windows", F.col(total))
        return joined.filter(F.col("windows") / F.col("item_windows") >= coverage).select(
            *keys, "item", F.struct(F.lit(reading).alias("reading"), "windows", "item_windows", "slots_changed").alias("match"))

    few = asked.count() <= BROADCAST_WINDOWS
    either = found(met.filter("plain"), 0, "plain_windows").unionByName(found(met.filter("usable"), 1, "usable_windows"))
    best = either.groupBy(*keys, "item").agg(F.min("match").alias("match")).select(*keys, "item", "match.*")
    best = best.select(*keys, F.col("item")["item_id"].alias("item_id"), "windows", "item_windows",
                       (F.col("windows") / F.col("item_windows")).alias("coverage"), "slots_changed")
    whole = _whole_matches(ours, items, sizes.select("item"))
    return best if whole is None else best.unionByName(whole)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that contain an item, all columns as they were; documents with a null id are judged too."""
    found = matches(docs, benchmark, text=text, doc_id=doc_id, **options)
    bad = found.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct()
    bad = broadcast_if_small(bad, BROADCAST_WINDOWS)
    packed = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"))
    same = (F.col("_hash") == F.col("_bad_hash")) & F.col("_id").eqNullSafe(F.col("_bad_id"))
    return packed.join(bad, same, "left_anti").select("_row.*")
