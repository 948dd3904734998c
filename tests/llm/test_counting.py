"""Source divergence, phrases and packing: brute force in plain Python, and the cases every operator must stand."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from lexigrove.llm import collocations, divergence, packing
from lexigrove.llm.wordstream import Sieve

PACKED, END = public_tokenizers.path("byte_bpe_50k.json"), 2
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, phrase string, run string, length string, hash string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long, tied and repeated rows, and columns with clashing names."""
    long = "The quick brown fox jumps over the lazy dog. " * 4000
    rest = (7, "t", "p", "r", "l", "h")
    rows = [
        (1, "Hello there, this is a plain text of some words.", "en", "a", *rest),
        (1, "Hello there, this is a plain text of some words.", "en", "a", *rest),
        (2, None, None, None, *[None] * 6),
        (3, "", "en", None, *rest),
        (4, " \n\t ", None, "b", *rest),
        (None, "An id is missing here but the text is fine.", "en", "b", *rest),
        (5, long, "en", "a", *rest),
        (6, "Hello there, this is a plain text of some words.", "en", "c", *rest),
        (7, "ünï¢ödé 漢字 👍🏽 \x00 <|endoftext|> end", "de", "c", *rest),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def made_up(seed, docs, words, langs=("en", "de", None), sources=("a", "b", "c", None)):
    """Texts over a small vocabulary with a skewed choice of words, sentence marks and line ends."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" if i % 3 else f"Ünd{i}" for i in range(words)]
    out = []
    for doc_id in range(docs):
        text = "".join(
            vocabulary[min(int(draw.expovariate(0.12)), words - 1)] + draw.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n"])
            for _ in range(draw.randrange(60)))
        out.append((doc_id, text if doc_id % 17 else None, draw.choice(langs), draw.choice(sources)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)


# divergence

def plain_audit(rows, least_docs, top):
    terms_of = [[t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                 for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r["text"] or "")] for r in rows]
    docs, counts = Counter(), defaultdict(Counter)
    for r, terms in zip(rows, terms_of, strict=True):
        lang, source = r["lang"] or "", r["source"] or ""
        docs.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        groups = {s: {t: c[t] for t in kept} for s, c in groups.items()}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}  # noqa: B023

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            pair = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            term = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_audit_equals_plain_counts(spark, monkeypatch):
    # sixteen sources over blocks of four rows and eight columns
    monkeypatch.setattr(divergence, "ROWS", 4)
    monkeypatch.setattr(divergence, "COLUMNS", 8)
    monkeypatch.setattr(divergence, "MOST_ENTRIES", 100)
    docs = frame(spark, made_up(1, 500, 60, sources=[f"s{i}" for i in range(15)] + [None]))
    assert as_rows(divergence.audit(docs, least_docs=12, top=7)) == plain_audit(docs.collect(), 12, 7)


@pytest.mark.parametrize("rows_a,rows_b,width", [(1, 1, 1), (3, 8, 8), (8, 5, 13), (8, 8, 16), (2, 2, 0)])
def test_trees_walked_together_equal_dense_matrices(rows_a, rows_b, width):
    draw = np.random.default_rng(rows_a * 100 + width)
    levels = 4

    def matrix(rows):
        zeros = draw.integers(1, 9, rows)
        dense = np.repeat(zeros[:, None], width, 1)
        row, col = np.nonzero(draw.random((rows, width)) < 0.2)
        dense[row, col] = values = draw.integers(10, 99, len(row))
        return dense, divergence.Quadtree(row, col, values, levels), zeros

    a, tree_a, zeros_a = matrix(rows_a)
    b, tree_b, zeros_b = matrix(rows_b)
    expected = np.abs(a[:, None, :] - b[None, :, :]).sum(2)
    assert (divergence.joint_distances(tree_a, tree_b, zeros_a, zeros_b, width) == expected).all()
    alike = np.triu(np.abs(a[:, None, :] - a[None, :, :]).sum(2), 1)
    assert (divergence.joint_distances(tree_a, tree_a, zeros_a, zeros_a, width) == alike).all()


def test_empty_quadrants_are_not_visited(monkeypatch):
    visited = []
    find = divergence.Quadtree.find
    monkeypatch.setattr(divergence.Quadtree, "find", lambda self, level, row, col: visited.append(len(row)) or find(self, level, row, col))
    one = np.array([0])
    tree = divergence.Quadtree(one, one, np.array([5]), 9)
    other = divergence.Quadtree(one, one, np.array([7]), 9)
    out = divergence.joint_distances(tree, other, np.full(64, 2), np.full(64, 3), 512)
    assert out[0, 0] == 2 + 511 and out[0, 1] == 2 + 511 and out[1, 0] == 5 + 511 and (out[1:, 1:] == 512).all()
    assert sum(visited) < 64 * 64 * 512 / 100


def test_audit_stands_odd_rows(spark, odd, nothing):
    assert as_rows(divergence.audit(odd, least_docs=1)) == plain_audit(odd.collect(), 1, 50)
    few = divergence.audit(odd).collect()  # no term in thirty documents
    assert few and {r["part"] for r in few} == {"pair"} and {r["value"] for r in few} == {0}
    assert divergence.audit(nothing).collect() == []


# phrases

def plain_mine(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = Counter(), Counter()
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r["text"] or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    candidates = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= least}
    longest = Counter()
    for (lang, words), n in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                key = lang, words[i : i + m]
                longest[key] = max(longest[key], n)
    out = []
    for lang in total:
        ranked = []
        for (x, words), a in candidates.items():
            if x != lang or 100 * longest[x, words] >= 80 * a and longest[x, words]:
                continue
            cuts = [(f[x, words[:k]], f[x, words[k:]]) for k in range(1, len(words))]
            score, k = min((2_000_000 * a // (lr[0] + lr[1]), k) for k, lr in enumerate(cuts))
            ranked.append((-score, -a, " ".join(words).encode(), *cuts[k]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("most_entries,burst", [(40, 4), (100_000, 4), (100_000, 4096)])
def test_phrases_equal_plain_counts(spark, monkeypatch, most_entries, burst):
    monkeypatch.setattr(collocations, "CHUNK", 37)
    monkeypatch.setattr(collocations, "MOST_PAIRS", 50)
    monkeypatch.setattr(collocations, "MOST_WORDS_KNOWN", 30 if most_entries == 40 else 10**6)
    docs = frame(spark, made_up(2, 300, 25))
    found = mined(collocations.mine(docs, least=5, top=60, most_entries=most_entries, burst=burst))
    assert found == plain_mine(docs.collect(), 5, 60) and len(found) > 60


def test_hash_that_is_always_too_high_changes_nothing(spark, monkeypatch):
    full = np.full(64, np.uint64(2**64 - 1))
    monkeypatch.setattr(collocations, "build_sieve", lambda keys, hashed, count: keys.sparkSession.sparkContext.broadcast(full))
    docs = frame(spark, made_up(3, 150, 20))
    assert mined(collocations.mine(docs, least=5)) == plain_mine(docs.collect(), 5, 2000)


def test_trie_bursts_and_gives_whole_subtrees():
    trie, wanted, draw = collocations.HatTrie(burst=3), Counter(), random.Random(4)
    bits = collocations.ID_BITS
    for _ in range(400):
        first, key = draw.randrange(1, 5), 0
        for level in range(draw.randrange(1, 4)):
            key |= draw.randrange(1, 6) << (2 - level) * bits
        n = draw.randrange(1, 9)
        trie.add(first, [key], [n])
        wanted[first, key] += n
    assert len(trie) == len(wanted)
    assert any(node[1] is not None for node in trie.roots.values())
    largest = trie.sizes.most_common(1)[0]
    (first, entries), = trie.take(len(trie) - 1)
    assert first == largest[0] and len(entries) == largest[1] and first not in trie.roots
    got = {(first, k): n for k, n in entries}
    for first, entries in trie.take(0):
        got |= {(first, k): n for k, n in entries}
    assert got == dict(wanted) and len(trie) == 0


def test_sieve_never_stops_a_key(spark):
    from lexigrove.llm.wordstream import build_sieve

    keys = spark.range(1000).selectExpr("xxhash64(id) AS h")
    sieve = Sieve(build_sieve(keys, "h", 1000).value)
    hashes = np.array([r["h"] for r in keys.collect()], np.int64).view(np.uint64)
    assert sieve.passes(hashes).all() and all(sieve.holds(int(h)) for h in hashes)
    others = np.random.default_rng(5).integers(0, 2**63, 10_000).astype(np.uint64)
    assert sieve.passes(others).mean() < 0.15
    assert [sieve.holds(int(h)) for h in others[:500]] == sieve.passes(others[:500]).tolist()


def test_phrases_stand_odd_rows(odd, nothing):
    assert mined(collocations.mine(odd, least=2)) == plain_mine(odd.collect(), 2, 2000)
    assert collocations.mine(nothing).collect() == []


# packing

def library():
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(PACKED)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", " ", "It's the dog's; we'll go,  they've   gone \n\n\n x\t\ty ", "a b　c \x1c\x1d d\x85e", "漢字かな交じり文 １２３ ½²", "👍🏽 <|endoftext|> É̂ x",
    "\u0000\x7f", "  leading", "trailing  ", "don'T 's'S 'ſ", "ﬁ ǅ ª º",
])
def test_ids_are_the_library_s(text):
    assert packing.Ids(PACKED).of([text, "plain"])[0].tolist() == library()(text)


@pytest.mark.parametrize("seed", range(20))
def test_ids_of_random_texts_are_the_library_s(seed):
    draw = random.Random(seed)
    signs = "ab 'sStT\t\n\r  .,!-é½²ßĿſª€…” 09" + ("漢\u00a0\u0085" if seed % 4 == 0 else "")
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(80))) for _ in range(60)]
    encode = library()
    assert [i.tolist() for i in packing.Ids(PACKED).of(texts)] == [encode(t) for t in texts]


def test_known_matches_are_let_go():
    ids, encode = packing.Ids(PACKED, most_known=3), library()
    texts = ["one two three", "four five six seven", "one seven"]
    assert [ids.of([t])[0].tolist() for t in texts] == [encode(t) for t in texts]
    assert len(ids.known) < 10


def check_packed(rows, docs, capacity):
    """Pieces hold each document's ids in order, and each sequence has no gaps and is no longer than allowed."""
    encode = library()
    texts = defaultdict(list)
    for r in docs:
        texts[r["doc_id"]].append(encode(r["text"]) + [END])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, all_ids in texts.items():
        expected = []
        for ids in all_ids:
            first = len(ids) % capacity or capacity
            starts = [0, *range(first, len(ids), capacity)]
            for number, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                expected.append((number, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        assert sorted(pieces[doc_id]) == sorted(expected)
    assert set(pieces) == set(texts)
    return len(sequences)


def test_packing_holds_all_tokens(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(docs.repartition(6), PACKED, END).collect()
    used = check_packed(rows, docs.collect(), 1024)
    assert used <= 1.02 * -(-sum(r["length"] for r in rows) // 1024)


def test_packing_gives_ids(spark):
    docs = spark.createDataFrame([("x", "some text here"), ("y", None)], "doc_id string, text string")
    rows = packing.pack(docs, PACKED, END, capacity=3, with_ids=True).collect()
    encode = library()
    ids = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["piece"]):
        ids[r["doc_id"]] += r["ids"]
    assert ids == {"x": encode("some text here") + [END], "y": [END]}


def test_packing_stands_odd_rows(odd, nothing):
    check_packed(packing.pack(odd, PACKED, END).collect(), odd.collect(), 1024)
    assert packing.pack(nothing, PACKED, END).collect() == []


def fewest(sizes, capacity):
    """The smallest number of bins, by search."""
    best = [len(sizes)]

    def place(left, bins):
        if len(bins) >= best[0]:
            return
        if not left:
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + left[0] <= capacity and bins[k] not in bins[:k]:
                place(left[1:], [*bins[:k], bins[k] + left[0], *bins[k + 1 :]])
        place(left[1:], [*bins, left[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_sound_and_near_the_fewest(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 16, 30])
    sizes = [draw.randrange(1, capacity + 1) for _ in range(draw.randrange(1, 12))]
    plan = packing.Plan(np.bincount(sizes, minlength=capacity + 1))
    numbers = Counter()
    places = []
    for s in sizes:
        places.append((s, numbers[s]))
        numbers[s] += 1
    lengths, ordinal = (np.array(x) for x in zip(*places, strict=True))
    sequence, offset = plan.place(lengths, ordinal)
    taken = sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist(), strict=True))
    ends = Counter()
    for q, at, n in taken:
        assert at == ends[q]
        ends[q] += n
    assert max(ends.values()) <= capacity and set(ends) == set(range(plan.sequences))
    assert plan.sequences <= fewest(sizes, capacity) + 1


def test_two_pieces_replace_the_shortest():
    # greedy takes 6 and 3; 2 and 2 fill the gap of 4 that 3 leaves
    plan = packing.Plan(np.bincount([6, 3, 2, 2], minlength=11))
    sequence, _ = plan.place(np.array([6, 2, 2]), np.array([0, 0, 1]))
    assert set(sequence.tolist()) == {0} and plan.sequences == 2


def test_plan_of_many_pieces_is_small():
    counts = np.random.default_rng(6).integers(0, 10**9, 1025)
    counts[0] = 0
    plan = packing.Plan(counts)
    assert plan.patterns < 20_000
    total = int((counts * np.arange(1025)).sum())
    assert plan.sequences <= 1.02 * total / 1024


# near copies

def test_profiles_rule_out_no_pair_that_is_alike():
    from lexigrove.llm import shingles

    draw = np.random.default_rng(8)
    for _ in range(200):
        n = int(draw.integers(1, 3000))
        whole = np.unique(draw.integers(-(2**63), 2**63 - 1, n))
        kept = whole[draw.random(len(whole)) < draw.choice([0.5, 0.8, 0.9, 1.0])]
        other = np.unique(np.r_[kept, draw.integers(-(2**63), 2**63 - 1, int(draw.integers(0, n // 8 + 1)))])
        p, q = (np.frombuffer(shingles.profile_of(x), np.uint8)[None] for x in (whole, other))
        common = len(np.intersect1d(whole, other))
        alike = 9 * common >= 4 * (len(whole) + len(other))
        assert not alike or shingles.may_be_alike(p, q, np.array([len(whole) + len(other)]))[0]
    crowded = np.arange(1000)  # all in one cell, more than a byte counts
    p = np.frombuffer(shingles.profile_of(crowded), np.uint8)[None]
    assert shingles.may_be_alike(p, p, np.array([2000]))[0]
    strangers = [np.frombuffer(shingles.profile_of(draw.integers(-(2**63), 2**63 - 1, 300)), np.uint8)[None] for _ in range(2)]
    assert not shingles.may_be_alike(*strangers, np.array([600]))[0]


def test_few_pairs_of_whole_sets_are_verified(spark, sf_dir, monkeypatch):
    from lexigrove.llm import shingles, simhash

    seen = []
    verified = shingles._verified
    monkeypatch.setattr(shingles, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    simhash.near_copies(docs).count()
    assert sum(seen) <= docs.count() / 10


def test_signs_that_are_no_letters_have_no_language():
    from lexigrove.llm import langid

    assert langid._LETTERS.findall("² ½ Ⅷ 12 _ ①") == [] and langid._LETTERS.findall("añb c2d") == ["añb", "c", "d"]
