"""Phrases whose words stand together more often than their parts, by language.

Each task counts phrases in a HAT-trie: the first word's number leads to a hash container that is keyed by the packed
numbers of the other words; a container that grows beyond ``BURST`` entries becomes a node by the next word with smaller
containers below. When the trie holds ``MOST_ENTRIES``, its largest subtrees leave it whole, as runs sorted by
phrase. Runs are dealt by the prefix (the first two words) and merged there, so a phrase has one sum; a prefix brings one
row for a phrase and run, however often it occurs.

There are three passes over the texts. Words are counted first. Then pairs of words that are frequent enough are counted by
hash, which can only give a pair too many occurrences. The third pass fills the trie with phrases all of whose words and
pairs may be frequent. What may be frequent reaches the tasks as a sieve of bounded size (``wordstream.Sieve``), which lets some others
through but never stops one; the trie's sums decide, so counts are exact.

Words are runs without blank and tab inside pieces between ``.,;:!?`` and line ends, with A-Z lower-cased. Overlapping
occurrences count. A phrase is a candidate from ``least`` occurrences; its weakest cut into two parts gives
``score = floor(2000000 * a / (l + r))``. A candidate goes if a longer one that holds it has 80 % of its occurrences.

Defined results: a null text is empty; a null language is ``und``; repeated rows count each; ties rank by more occurrences, then
by the bytes of the phrase; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigrove.llm.wordstream import Sieve, build_sieve, seeded, slices
from lexigrove.plans.runtime import materialize, scratch_scope

LEAST, MOST_WORDS, SCALE = 30, 4, 2_000_000
#: A candidate goes if a longer one has this share of its occurrences.
ABSORBED = (80, 100)
#: Entries of a container before it is burst, and of a task's trie before subtrees are spilled.
BURST, MOST_ENTRIES = 4096, 400_000
#: Word numbers have so many bits, so three of them fit into one key.
ID_BITS = 21
#: Occurrences of pairs that are put together at a time.
MOST_PAIRS = 2_000_000
#: Known words of a task, frequent or not, before trie and numbers start anew.
MOST_WORDS_KNOWN = 500_000
#: Words that are read at a time, with the next three behind them; known and new words together have numbers below ``2**ID_BITS``.
CHUNK = 1 << 19

_BREAK = b"\xff"  # no byte of UTF-8
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" ")
_RUN, _NAMES = "lang string, part int, phrases array<string>, counts array<long>", ["lang", "part", "phrases", "counts"]
#: Prefix partitions of a language: one for so many frequent pairs, within these bounds.
PAIRS_EACH, FEWEST_PARTS, MOST_PARTS = 4096, 64, 1 << 16
#: Phrases that a merging task gathers before it adds them up again.
MERGED_ROWS = 500_000
#: Bits of a pair's hash that are sent; more than a sieve looks at.
_PAIR_MASK = np.uint64((1 << 40) - 1)


def split_words(texts: list[bytes]) -> list[bytes]:
    """Words of all texts, with a break between pieces and between texts."""
    return _BREAK.join(texts).translate(_BYTES).replace(_BREAK, b" \xff ").split()


class _Words(dict):
    """Numbers of the words of one language from 1; 0 for a break or a word that the sieve stops."""

    def __init__(self, owner: Vocabulary, lang: str):
        self.owner, self.seed = owner, seeded(lang)
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        owner = self.owner
        hashed = xxhash.xxh64_intdigest(word, seed=self.seed)
        number = 0
        if owner.sieve.holds(hashed):
            number = len(owner.names)
            owner.names.append(word)
            owner.hashes.append(hashed)
        self[word] = number
        owner.known += 1
        return number


class Vocabulary:
    """The words of all languages that a task met and that pass the sieve: name, hash and language by number."""

    def __init__(self, sieve: Sieve):
        self.sieve, self.by_lang, self.known = sieve, {}, 0
        self.names, self.hashes, self.langs = [b""], [0], [""]

    def chunks(self, lang: str, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of the words and hashes by number, a chunk at a time with the next words behind it."""
        words = split_words(texts)
        for start in range(0, len(words), CHUNK):
            known = self.by_lang.get(lang)
            if known is None:
                known = self.by_lang[lang] = _Words(self, lang)
            part = words[start : start + CHUNK + MOST_WORDS - 1]
            ids = np.fromiter(map(known.__getitem__, part), np.int64, len(part))
            self.langs += [lang] * (len(self.names) - len(self.langs))
            yield ids, np.array(self.hashes, np.uint64)[ids]

    def forget(self) -> None:
        self.__init__(self.sieve)


class HatTrie:
    """Counts of phrases of word numbers: nodes by word above, hash containers by the packed rest below.

    A phrase is its first number and one key of the others, the second in the highest bits and 0 for none. Nodes are
    ``[container, children]``: while ``children`` is None the container holds all, after it is burst only what ends there.
    """

    def __init__(self, burst: int = BURST):
        self.roots: dict[int, list] = {}
        self.sizes: Counter = Counter()
        self.burst = burst

    def __len__(self) -> int:
        return self.sizes.total()

    def add(self, first: int, keys: list[int], counts: list[int]) -> None:
        """Add counts of phrases that begin with ``first``; keys are distinct."""
        root = self.roots.get(first)
        if root is None:
            root = self.roots[first] = [{}, None]
        self.sizes[first] += self._add(root, keys, counts, 2 * ID_BITS)

    def _add(self, node: list, keys: list[int], counts: list[int], shift: int) -> int:
        container, children = node
        new = 0
        if children is None:
            before = len(container)
            for key, n in zip(keys, counts, strict=True):
                container[key] = container.get(key, 0) + n
            new = len(container) - before
            if len(container) > self.burst and shift:
                self._split(node, shift)
            return new
        below = (1 << shift) - 1
        parts: dict[int, tuple[list, list]] = {}
        for key, n in zip(keys, counts, strict=True):
            part = parts.setdefault(key >> shift, ([], []))
            part[0].append(key & below)
            part[1].append(n)
        for word, (rest, ns) in parts.items():
            child = children.get(word)
            if child is None:
                child = children[word] = [{}, None]
            new += self._add(child, rest, ns, shift - ID_BITS)
        return new

    def _split(self, node: list, shift: int) -> None:
        below = (1 << shift) - 1
        children: dict[int, list] = {}
        for key, n in node[0].items():
            child = children.get(key >> shift)
            if child is None:
                child = children[key >> shift] = [{}, None]
            child[0][key & below] = n
        node[0], node[1] = {}, children
        for child in children.values():
            if len(child[0]) > self.burst and shift > ID_BITS:
                self._split(child, shift - ID_BITS)

    def _walk(self, node: list, above: int, shift: int) -> Iterator[tuple[int, int]]:
        for key, n in node[0].items():
            yield above | key, n
        for word, child in (node[1] or {}).items():
            yield from self._walk(child, above | word << shift, shift - ID_BITS)

    def take(self, room: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Remove the largest subtrees until ``room`` entries are left: ``(first, [(key, count)])``."""
        held = len(self)
        for first, size in self.sizes.most_common():
            if held <= room:
                return
            held -= size
            del self.sizes[first]
            yield first, list(self._walk(self.roots.pop(first), 0, 2 * ID_BITS))


class PhraseCounter:
    """A task's trie over what passes the sieves; yields sorted runs when it is full."""

    def __init__(self, words: Sieve, pairs: Sieve, parts: int, most_entries: int, burst: int):
        self.words, self.pairs, self.parts, self.most = Vocabulary(words), pairs, parts, most_entries
        self.trie = HatTrie(burst)

    def read(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for ids, hashes in self.words.chunks(lang, texts):
            for first, key in self._phrases(ids, hashes):
                self._insert(first, key)
            if len(self.trie) > self.most:
                yield from self._spill(self.most // 2)
            if self.words.known > MOST_WORDS_KNOWN:
                yield from self._spill(0)
                self.words.forget()

    def _phrases(self, ids: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Occurrences of two, three and four words that begin in the chunk: the first word and the key of the others."""
        pair = _pairs(ids)
        pair[pair] = self.pairs.passes(_pair_hash(hashes[:-1][pair], hashes[1:][pair]))
        at = np.flatnonzero(pair)
        key, whole = ids[at + 1] << 2 * ID_BITS, at
        yield ids[whole[whole < CHUNK]], key[whole < CHUNK]
        for more in (1, 2):
            follows = np.searchsorted(at, whole + more)
            longer = follows < len(at)
            longer[longer] = at[follows[longer]] == whole[longer] + more
            whole, key = whole[longer], key[longer]
            key = key | ids[whole + more + 1] << (2 - more) * ID_BITS
            yield ids[whole[whole < CHUNK]], key[whole < CHUNK]

    def _insert(self, first: np.ndarray, key: np.ndarray) -> None:
        """Add occurrences, equal ones at once."""
        if not len(first):
            return
        order = np.lexsort((key, first))
        first, key = first[order], key[order]
        new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (key[1:] != key[:-1])])
        counts = np.diff(np.r_[new, len(first)])
        first, key = first[new], key[new]
        starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        keys, counts = key.tolist(), counts.tolist()
        for word, a, b in zip(first[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(first)], strict=True):
            self.trie.add(word, keys[a:b], counts[a:b])

    def _spill(self, room: int) -> Iterator[pa.RecordBatch]:
        firsts, keys, counts = [], [], []
        for first, entries in self.trie.take(room):
            firsts += [first] * len(entries)
            for key, n in entries:
                keys.append(key)
                counts.append(n)
        if not keys:
            return
        names, key, mask = self.words.names, np.array(keys, np.int64), (1 << ID_BITS) - 1
        order = sorted(range(len(names)), key=names.__getitem__)  # a number's place among the words
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        words = [np.array(firsts), key >> 2 * ID_BITS, key >> ID_BITS & mask, key & mask]
        hashes = np.array(self.words.hashes, np.uint64)
        part = (_pair_hash(hashes[words[0]], hashes[words[1]]) % np.uint64(self.parts)).astype(np.int32)
        codes, langs = np.unique(np.array(self.words.langs, object), return_inverse=True)[::-1]
        lang = codes[words[0]]
        run = np.lexsort([*(place[w] for w in reversed(words)), part, lang])
        lang, part, counts = lang[run], part[run], np.array(counts, np.int64)[run]
        names = pa.array(names, pa.binary())
        first, *rest = (names.take(pa.array(w[run])) for w in words)
        phrase = pc.binary_join_element_wise(first, rest[0], b" ")
        for more, word in zip(rest[1:], words[2:], strict=True):
            phrase = pc.if_else(pa.array(word[run] > 0), pc.binary_join_element_wise(phrase, more, b" "), phrase)
        starts = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (part[1:] != part[:-1])])
        ends = pa.array(np.r_[starts, len(run)].astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            pa.array(langs[lang[starts]], pa.string()), pa.array(part[starts]),
            pa.ListArray.from_arrays(ends, phrase.cast(pa.string())), pa.ListArray.from_arrays(ends, pa.array(counts))], _NAMES)

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self._spill(0)


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Where a word and the next one both have numbers."""
    return (ids[:-1] > 0) & (ids[1:] > 0)


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left ^ (right << np.uint64(21) | right >> np.uint64(43))


def _count_pairs(batches: Iterator[pa.RecordBatch], words: Sieve) -> Iterator[pa.RecordBatch]:
    """Hashes of pairs of words that pass the sieve, as sorted runs of ``(hash, n)``."""
    known = Vocabulary(words)
    held: list[np.ndarray] = []

    def run() -> Iterator[pa.RecordBatch]:
        found, n = np.unique(np.concatenate([np.empty(0, np.int64), *held]), return_counts=True)
        held.clear()
        for start in range(0, len(found), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(found[start : start + 50_000]), pa.array(n[start : start + 50_000])], ["hash", "n"])

    for part in slices(batches, "text"):
        for lang, texts in _by_lang(part).items():
            for ids, hashes in known.chunks(lang, texts):
                pair = _pairs(ids)
                pair[CHUNK:] = False
                held.append((_pair_hash(hashes[:-1][pair], hashes[1:][pair]) & _PAIR_MASK).astype(np.int64))
        if sum(map(len, held)) > MOST_PAIRS:
            yield from run()
        if known.known > MOST_WORDS_KNOWN:
            known.forget()
    yield from run()


def _by_lang(part: pa.RecordBatch) -> dict[str, list[bytes]]:
    found: dict[str, list[bytes]] = {}
    for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
        found.setdefault(lang, []).append(text)
    return found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single words have no inner nodes: one container a language, spilled whole."""
    counts: dict[str, Counter] = {}

    def run() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            words = sorted(found)
            for start in range(0, len(words), 50_000):
                part = words[start : start + 50_000]
                names, n = pa.array(part, pa.binary()).cast(pa.string()), pa.array([found[w] for w in part], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), names, n], ["lang", "phrase", "n"])
        counts.clear()

    for part in slices(batches, "text"):
        for lang, texts in _by_lang(part).items():
            counts.setdefault(lang, Counter()).update(split_words(texts))
            counts[lang].pop(_BREAK, None)
        if sum(map(len, counts.values())) > MOST_ENTRIES:
            yield from run()
    yield from run()


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """``(lang, phrase, n)`` with ``least`` occurrences: the runs of each prefix partition, merged as they arrive."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[pa.Table] = []
        bound, names = MERGED_ROWS, ["lang", "phrase", "n"]

        def summed() -> pa.Table:
            sums = pa.concat_tables(gathered).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
            return sums.rename_columns(names)

        for batch in batches:
            lists = batch.column("phrases")
            lang = batch.column("lang").take(pc.list_parent_indices(lists))
            gathered.append(pa.table([lang, pc.list_flatten(lists), pc.list_flatten(batch.column("counts"))], names))
            if sum(t.num_rows for t in gathered) > bound:
                gathered = [summed()]
                bound = max(MERGED_ROWS, 2 * gathered[0].num_rows)
        if gathered:
            found = summed()
            yield from found.filter(pc.greater_equal(found["n"], least)).to_batches(max_chunksize=50_000)

    return runs.repartition("lang", "part").mapInArrow(merge, "lang string, phrase string, n long")


def phrase_counts(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, most_entries: int = MOST_ENTRIES, burst: int = BURST
) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, n)`` of all phrases of 1 to 4 words with ``least`` occurrences, and ``(lang, total)`` of words.

    Runs jobs when called; both are stored tables.
    """
    body = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    words = body.mapInArrow(_count_words, "lang string, phrase string, n long").repartition("lang", "phrase")
    words = materialize(words.groupBy("lang", "phrase").agg(F.sum("n").alias("n")))
    totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("total")))
    single = words.filter(F.col("n") >= least)
    word_sieve = build_sieve(single.select(F.xxhash64("lang", "phrase").alias("hash")), "hash", single.count())

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count_pairs(batches, Sieve(word_sieve.value))

    hashed = body.mapInArrow(count_pairs, "hash long, n long").repartition("hash").groupBy("hash").agg(F.sum("n").alias("n"))
    hashed = materialize(hashed.filter(F.col("n") >= least).select("hash"))
    n_pairs = hashed.count()
    pair_sieve = build_sieve(hashed, "hash", n_pairs)
    parts = min(MOST_PARTS, max(FEWEST_PARTS, n_pairs // PAIRS_EACH))

    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(Sieve(word_sieve.value), Sieve(pair_sieve.value), parts, most_entries, burst)
        for part in slices(batches, "text"):
            for name, texts in _by_lang(part).items():
                yield from counter.read(name, texts)
        yield from counter.rest()

    longer = _merged(body.mapInArrow(count_phrases, _RUN), least)
    return materialize(single.unionByName(longer).withColumn("words", F.size(F.split("phrase", " ")))), totals


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("parts", first, length), " ")


def mine(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = 2000,
    most_entries: int = MOST_ENTRIES, burst: int = BURST,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases. Runs jobs when called."""
    with scratch_scope(docs.sparkSession):
        counts, totals = phrase_counts(docs, text=text, lang=lang, least=least, most_entries=most_entries, burst=burst)
        candidates = counts.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"), "words", F.split("phrase", " ").alias("parts"))
        cuts = candidates.select("lang", "phrase", "a", "parts", "words", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
            "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
        scored = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(
            counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
        # whole numbers of up to 38 digits
        score = F.expr(f"(cast({SCALE} as decimal(7, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
        weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        inner = candidates.filter("words > 2").select("lang", "a", "words", "parts", F.explode(F.expr("sequence(2, words - 1)")).alias("length")).select(
            "lang", "a", "parts", "length", F.explode(F.expr("sequence(1, words - length + 1)")).alias("at"))
        held = inner.select("lang", _part(F.col("at"), F.col("length")).alias("phrase"), F.col("a").alias("longer"))
        held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        share, whole = (F.lit(x).cast("decimal(3,0)") for x in ABSORBED)
        absorbed = F.coalesce(whole * F.col("longer").cast("decimal(19,0)") >= share * F.col("a").cast("decimal(19,0)"), F.lit(False))
        left = weakest.join(held, ["lang", "phrase"], "left").filter(~absorbed)
        left = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
        return materialize(ranked.join(totals, "lang").select(
            "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"), outlive=True)
