"""The training-data operators on small tables: brute force, round trips, and the cases every one must stand."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from lexigrove.llm import bpe, decontaminate, fuzzyhash, langid, pii, quality, shards, shingles, simhash, toxicity, urls
from lexigrove.llm.oracles import LLM_ORACLES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fingerprint string, _row string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long, tied and repeated rows, and columns with clashing names."""
    long = "The quick brown fox jumps over the lazy dog. " * 4000
    rows = [
        (1, "Hello there, this is a plain text of some words.", "en", "a", 48, "s", "f", "r"),
        (1, "Hello there, this is a plain text of some words.", "en", "a", 48, "s", "f", "r"),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", None, 0, "s", None, "r"),
        (4, " \n\t ", None, "b", 4, None, "f", None),
        (None, "An id is missing here but the text is fine.", "en", "b", 43, "s", "f", "r"),
        (5, long, "en", "a", len(long), "s", "f", "r"),
        (6, "Hello there, this is a plain text of some words.", "en", "c", 48, "s", "f", "r"),
        (7, "ünï¢ödé 漢字 👍🏽 \x00 end", "de", "c", 20, "s", "f", "r"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.collect()), key=lambda x: (x is None, x))


ALL_IDS = [1, 1, 2, 3, 4, 5, 6, 7, None]


# sharding

def test_shards_balance_groups_and_slots(documents):
    rows = shards.kd_shards(documents, n_shards=16).collect()
    assert len(rows) == documents.count()
    by_shard, by_text = {}, {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
        by_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert set(by_shard) == set(range(16))
    assert all(len(s) == 1 for s in by_text.values())
    for members in by_shard.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    sizes = [sum(r["size"] for r in m) for m in by_shard.values()]
    largest = max(sum(r["size"] for r in rows if (r["text_crc32"], r["size"]) == k) for k in by_text)
    assert max(sizes) - min(sizes) <= largest


def test_shards_of_a_hot_group_and_by_bytes(spark, odd, nothing):
    rows = [(i, "same text for a third of all", "en", "x") for i in range(100)] + [(100 + i, f"text {i} " * 9, "de", f"s{i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = shards.kd_shards(docs, n_shards=8).collect()
    hot = {r["shard"] for r in out if r["doc_id"] < 100}
    assert len(hot) == 1 and len({r["shard"] for r in out}) == 8
    assert ids(shards.kd_shards(odd, n_shards=4)) == ALL_IDS
    assert shards.kd_shards(odd, target_bytes=100_000).agg(F.max("shard")).first()[0] >= 1
    assert shards.kd_shards(nothing, n_shards=16).count() == 0


# decontamination

def test_templates_find_other_values(spark, odd, nothing):
    asked = spark.createDataFrame(
        [(1, "A train leaves Paris at 9 and travels 120 km in 3 hours how fast did it go"), (2, "too short"), (3, None),
         (4, "Take 7 apples from 12 apples and then add 7 pears what is left of them")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "Well. A train leaves Boston at 7 and travels 350 km in 5 hours how fast did it go? So.", 1),
         (2, "A train leaves Paris at 9 and travels 120 km in 3 hours how fast did it go", 2),
         (3, "A train leaves Paris and nobody knows how fast it can go", 3),
         (4, "take 3 apples from 12 apples and then add 5 pears what is left of them", 4),
         (5, "take 3 apples from 15 apples and then add 3 pears what is left of them", 5), (6, None, 6)],
        "doc_id long, text string, item_id long")
    found = {(r["doc_id"], r["item_id"]): r["slots_changed"] for r in decontaminate.matches(docs, asked).collect()}
    assert set(found) == {(1, 1), (2, 1), (5, 4)}  # in 4 the value 7 is replaced by 3 and by 5
    assert found[2, 1] == 0 and found[1, 1] == 4 and found[5, 4] == 2
    left = decontaminate.drop_contaminated(docs, asked)
    assert ids(left) == [3, 4, 6] and left.columns == docs.columns
    assert ids(decontaminate.drop_contaminated(odd, asked)) == ALL_IDS
    assert decontaminate.drop_contaminated(nothing, asked).count() == 0
    assert ids(decontaminate.drop_contaminated(odd, asked.limit(0))) == ALL_IDS


def test_names_that_begin_a_sentence_are_slots(spark):
    asked = spark.createDataFrame(
        [(1, "Tom has 12 apples. Anna has 7 apples. How many more apples does Tom have than Anna?")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "Tom has 12 apples. Anna has 7 apples. How many more apples does Tom have than Anna?"),
         (2, "Lisa has 30 apples. Paul has 9 apples. How many more apples does Lisa have than Paul?"),
         (3, "He asked:\n\u201cLisa has 30 apples. (Paul has 9 apples.) How many more apples does Lisa have than Paul?\u201d"),
         (4, "Lisa has 30 apples. Paul has 9 apples. How many more apples does Paul have than Lisa?"),
         (5, "Lisa has 30 pears and Paul likes 9 of them. How many does Lisa have?"), (None, None)], "doc_id long, text string")
    found = {r["doc_id"]: (r["coverage"], r["slots_changed"]) for r in decontaminate.matches(docs, asked).collect()}
    assert found == {1: (1.0, 0), 2: (1.0, 4), 3: (1.0, 4)}  # in 4 the names are exchanged
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, asked).collect()}
    assert left == {4, 5, None}


def test_short_items_are_found_as_whole_texts(spark, odd, nothing):
    asked = spark.createDataFrame(
        [(1, "What is 12 + 7 * 3?"), (2, "Who painted Guernica?"), (3, "12 + 7"), (4, ""), (5, None), (6, "Add 3 to 3."), (None, "Define entropy")],
        "item_id long, text string")
    texts = ["What is 12 + 7 * 3?", "what is 5, 6, 8", "Who painted Guernica?", "Who painted Lisbon?", "who sold Guernica", "7 + 12", "12+7", "",
             None, "Add 9 to 9", "Add 9 to 8", "DEFINE  entropy", "What is 12 + 7 * 3? Nobody knows what that is, says everyone.", "What is 12 + 7 * 3?"]
    docs = spark.createDataFrame([(min(i, 12), t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    found = [(r["doc_id"], r["item_id"], r["slots_changed"]) for r in decontaminate.matches(docs, asked).collect()]
    assert sorted(found, key=str) == sorted(
        [(0, 1, 0), (1, 1, 3), (2, 2, 0), (3, 2, 1), (6, 3, 0), (9, 6, 1), (11, None, 0), (12, 1, 0)], key=str)
    left = decontaminate.drop_contaminated(docs, asked)
    assert [r["doc_id"] for r in left.orderBy("doc_id").collect()] == [4, 5, 7, 8, 10, 12] and left.columns == docs.columns
    assert ids(decontaminate.drop_contaminated(odd, asked)) == ALL_IDS
    assert decontaminate.drop_contaminated(nothing, asked).count() == 0


def test_sql_of_decontamination_states_short_items(spark, tmp_path):
    items = [(1, "What is 12 + 7 * 3?"), (2, "Who painted Guernica?"), (3, "12 + 7"), (4, "A train leaves at 9 and travels 120 km in 3 hours how fast")]
    texts = ["what is 1 2 3", "what is 1 2 1", "Who painted Guernica", "7 + 12", "12 7", "a train leaves at 8 and travels 90 km in 5 hours how fast", "", "Who knows?"]
    spark.createDataFrame(items, "item_id long, text string").createOrReplaceTempView("benchmark")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ours = decontaminate.matches(docs, spark.table("benchmark")).drop("text_hash").collect()
    held = duckdb.connect()
    held.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR); CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    held.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    held.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert sorted(map(tuple, ours)) == sorted(held.execute(LLM_ORACLES["op2_decontaminate"]).fetchall())
    assert {r["doc_id"] for r in ours} == {0, 1, 2, 4, 5}


# toxicity

def test_marginals_are_those_of_all_labelings(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    draw = np.random.default_rng(1)
    field = toxicity.Field(np.zeros((4, 1 << toxicity.BITS)), draw.normal(size=(2, 2)))
    sizes, e = [7, 0, 8, 1], draw.normal(size=16) * 2
    got = toxicity.marginals(field, e, sizes)
    start, expected = 0, []
    for n in sizes:
        total, toxic = 0.0, np.zeros(n)
        for labels in itertools.product([0, 1], repeat=n):
            weight, before = 0.0, 0
            for k, y in enumerate(labels):
                weight += field.pairs[before, y] + (e[start + k] if y else 0)
                before = y
            total += np.exp(weight)
            toxic += np.exp(weight) * np.array(labels)
        expected += list(toxic / total) if n else []
        start += n
    assert np.allclose(got, expected)


def test_toxic_spans_and_odd_rows(spark, odd, nothing):
    draw = random.Random(5)
    words = [a + b for a in ("ba", "do", "ri", "su") for b in ("ka", "le", "mi", "to", "nu")]
    rows = []
    for i in range(300):
        body = [draw.choice(words) for _ in range(30)]
        if i % 3 == 0:
            body[draw.randrange(30)] = draw.choice(["Moron", "idiot"])
        rows.append((i, " ".join(body), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.filter("doc_id < 200"), docs.select("doc_id", "toxic"))
    out = {r["doc_id"]: r for r in toxicity.tag(docs.filter("doc_id >= 200"), model).collect()}
    for i, text, y in rows[200:]:
        assert (out[i]["score"] >= 0.7) == bool(y)
        assert [text[s["start"] : s["end"]] for s in out[i]["spans"]] == [w for w in text.split() if w in ("Moron", "idiot")]
    assert ids(toxicity.tag(odd, model)) == ALL_IDS
    assert toxicity.tag(nothing, model).count() == 0
    unlearned = toxicity.fit(nothing, docs.select("doc_id", "toxic"))
    assert {r["score"] < 0.7 for r in toxicity.tag(odd, unlearned).collect()} == {True}


def test_toxicity_held_out(spark, documents):
    from lexigrove.llm import catalog

    # sf0.01 has some 30 toxic documents to learn from; about 300 are enough to meet most words again
    rows = catalog.op3_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    right = held[(held.predicted == 1) & (held.toxic == 1)]
    assert len(right) >= 0.8 * held.toxic.sum() and len(right) >= 0.9 * held.predicted.sum()
    assert rows.score.between(0, 1).all()


# language

def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(["▁", "▁a", "a", "b", "ab", "▁ab"])
    chances = np.random.default_rng(3).random((pieces.size, 2)) * 0.1
    chances[-1] = 0
    chances[-2] = langid.UNKNOWN

    def every(rest):
        if not rest:
            yield np.ones(2)
        for k in range(1, len(rest) + 1):
            number = pieces.number.get(rest[:k], pieces.size - 2 if k == 1 else None)
            if number is not None:
                for tail in every(rest[k:]):
                    yield chances[number] * tail

    words = ["ab", "aab", "b", "abab", "axb"]
    got = pieces.log_chances(words, chances)
    for word, row in zip(words, got, strict=True):
        assert np.allclose(row, np.log(sum(every("▁" + word))))


def test_long_runs_of_letters_are_summed_over_all_segmentations():
    draw = np.random.default_rng(3)
    pieces = langid.Pieces(sorted({langid.START, "a", "b", "ab", "ba", "aab", langid.START + "a", "babb"}))
    chances = draw.random((pieces.size, 3)) / 20
    chances[-2:] = [[langid.UNKNOWN] * 3, [0] * 3]
    with np.errstate(divide="ignore"):
        logs = np.log(chances)
    for word in ("a", "abba", "abxab", "ab" * 20):
        assert np.allclose(pieces.log_chance_of_long(word, logs), pieces.log_chances([word], chances)[0])
    scorer = langid.Scorer(sorted(pieces.number), ["x", "y", "z"], chances)
    long = "ab" * 30 + "c" + "ba" * 3000
    assert np.isfinite(pieces.log_chance_of_long(long, logs)).all()
    names, scores = scorer.predict([long, "ab", f"ab {long}", None])
    totals = pieces.log_chance_of_long(long, logs)
    assert names[0] == names[2] == "xyz"[totals.argmax()] and names[3] == "und" and 0 < scores[0] <= 1


def test_language_held_out_and_odd_rows(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.filter("doc_id % 3 <> 1"), RANKS)
    rows = langid.identify(docs.filter("doc_id % 3 = 1"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    out = langid.identify(odd, model).collect()
    assert ids(langid.identify(odd, model)) == ALL_IDS
    assert {r["lang_pred"] for r in out if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert langid.identify(nothing, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit(nothing, RANKS)).collect()} == {"und"}


# SimHash

def brute_components(prints, bits=3):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= bits) + i + 1:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, documents, odd, nothing):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    roots = brute_components([plain_fingerprint(t) for _, t in texts])
    smallest = {}
    for (i, _), r in zip(texts, roots, strict=True):
        smallest[r] = min(smallest.get(r, i), i)
    expected = {(i, f"{plain_fingerprint(t):016x}", smallest[r]) for (i, t), r in zip(texts, roots, strict=True)}
    assert {tuple(r) for r in simhash.components(documents).collect()} == expected
    out = simhash.components(odd).collect()
    assert sorted((r["doc_id"] for r in out), key=lambda x: (x is None, x)) == ALL_IDS
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out}
    assert got[2] == got[3] == got[4] == ("0" * 16, 2) and got[6][1] == got[1][1] == 1 and got[None][1] is None
    assert simhash.components(nothing).count() == 0


def test_full_variants_are_cut_further(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 16)
    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(4)]
    prints = set()
    for _ in range(700):
        x = draw.choice(centres)
        for b in draw.sample(range(0, 64, 3), draw.randint(0, 6)):
            x ^= 1 << b
        prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(x, x) for x in prints], "node long, fp long")
    roots = {r["node"]: r["root"] for r in simhash.connected_components(simhash.links(nodes, ["fp"])).collect()}
    expected = brute_components([x & (2**64 - 1) for x in prints])
    assert [roots.get(x, x) for x in prints] == [prints[k] for k in expected]


def test_near_copies_leave_one_row(spark, odd, nothing):
    draw = random.Random(9)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    base = [draw.choice(vocabulary) for _ in range(300)]
    rows = []
    for i in range(40):
        body = list(base)
        for _ in range(2):
            body[draw.randrange(300)] = draw.choice(vocabulary)
        rows.append((i, " ".join(body)))
    rows += [(100 + i, " ".join(draw.choice(vocabulary) for _ in range(200))) for i in range(60)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ids(kept) == [0, *range(100, 160)]
    left = simhash.keep_one(odd)
    assert left.columns == odd.columns and ids(left) == [1, 2, 5, 7, None]
    assert simhash.keep_one(nothing).count() == 0


def brute_kept(rows):
    """Smallest id of each component of exact similarity 0.8 on five-word shingles."""
    sets = []
    for _, text in rows:
        words = text.lower().split()
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if 10 * common >= 8 * (len(sets[i]) + len(sets[j]) - common):
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    return sorted(min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root))


def test_near_copies_are_those_of_exact_similarity(spark, documents, monkeypatch):
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = []
    for group in range(30):  # copies on either side of 0.8: a changed word costs up to five shingles of 116
        base = [draw.choice(words) for _ in range(120)]
        for edits in (0, 1, 2, 2, 3, 3, 4, 5):
            body = list(base)
            for k in draw.sample(range(120), edits):
                body[k] = draw.choice(words)
            rows.append((len(rows), " ".join(body)))
    form = [draw.choice(words) for _ in range(40)]
    rows += [(1000 + i, " ".join([*form, *(str(draw.randrange(10)) for _ in range(6)), *form[:9]])) for i in range(60)]  # one set of long words
    monkeypatch.setattr(shingles, "BLOCK", 8)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ids(kept) == brute_kept(rows)
    given = [(r["doc_id"], r["text"] or "") for r in documents.collect()]
    assert ids(simhash.keep_one(documents)) == brute_kept(given)


def test_changed_copies_of_one_text_meet_at_centres(spark, monkeypatch):
    draw, base, rows = random.Random(4), [f"w{i}" for i in range(300)], []
    for _ in range(400):
        words = list(base)
        for at in draw.sample(range(len(words)), 6):
            words[at] = f"x{draw.random()}"
        rows.append(" ".join(words))
    rows.append(" ".join(base))
    sets = [shingles.shingle_set(shingles.word_hashes([w.encode() for w in r.split()])) for r in rows]
    alike = sum(9 * len(np.intersect1d(p, q)) >= 4 * (len(p) + len(q)) for p, q in itertools.combinations(sets[:60], 2))
    assert alike < 60 * 59 / 2 / 3  # most copies are like the text itself only
    asked, plausible = [], shingles._plausible

    def counted(pairs, nodes):
        asked.append(pairs.count())
        return plausible(pairs, nodes)

    monkeypatch.setattr(shingles, "_plausible", counted)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.keep_one(docs).collect()] == [0]
    assert sum(asked) < 401 * 400 / 2 / 4


def test_rows_beyond_the_last_cut_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    monkeypatch.setattr(simhash, "deeper", lambda mask, max_bits: [])
    draw = random.Random(5)
    bases = [draw.getrandbits(29) for _ in range(20)]
    prints = sorted([*bases, *(x | 7 << 29 for x in bases)])  # equal in the upper half; partners are far apart in order
    nodes = spark.createDataFrame([(x, x) for x in prints], "node long, fp long")
    roots = {r["node"]: r["root"] for r in simhash.connected_components(simhash.links(nodes, ["fp"])).collect()}
    expected = brute_components(prints)
    assert [roots.get(x, x) for x in prints] == [prints[k] for k in expected]


def test_one_candidate_fingerprint_with_many_texts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    monkeypatch.setattr(shingles, "BLOCK", 8)
    draw = random.Random(6)
    long = ["common", "letters", "without", "numbers"] * 2
    bases = [[str(draw.randrange(1000)) for _ in range(60)] for _ in range(15)]
    rows = []
    for base in bases:
        for _ in range(4):
            body = list(base)
            body[draw.randrange(60)] = str(draw.randrange(1000))
            rows.append((len(rows), " ".join(long + body)))
    draw.shuffle(rows)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ids(kept) == brute_kept(rows)


# byte pairs

def test_bpe_is_that_of_the_library(spark, documents, odd, nothing):
    raw = bpe.read_ranks(RANKS)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(raw), special_tokens={})
    encoder, decoder = bpe.Encoder(raw, public_tokenizers.PATTERN), bpe.StreamDecoder(raw)
    draw = random.Random(4)
    letters = "abcdeihtn '’.,\n  аеéñ漢字かaあ한👍🏽éthe1\t"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        tokens = encoder.encode(text)
        assert tokens == theirs.encode_ordinary(text)
        assert decoder.decode(tokens) == text
    rows = bpe.decode(bpe.encode(odd, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(rows) == 9 and all(r["decoded"] == (r["text"] or "") for r in rows)
    assert all(r["token_ids"] == theirs.encode_ordinary(r["text"] or "") for r in rows)
    both = bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r["token_ids"], r["decoded"]) for r in both) == sorted((r["token_ids"], r["decoded"]) for r in rows)
    assert bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_tables_of_the_transducer_may_be_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_WORDS", 20)
    raw = bpe.read_ranks(RANKS)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(raw), special_tokens={})
    encoder = bpe.Encoder(raw, public_tokenizers.PATTERN)
    draw = random.Random(6)
    text = " ".join("".join(draw.choice("aeinrst") for _ in range(9)) for _ in range(500)) + " " + "a" * 5000
    assert encoder.encode(text) == theirs.encode_ordinary(text)


def test_stream_decoder_replaces_what_is_no_character():
    raw = bpe.read_ranks(RANKS)
    ranks, decoder, draw = bpe.parse_ranks(raw), bpe.StreamDecoder(raw), random.Random(8)
    for _ in range(1000):
        data = bytes(draw.choice([draw.randrange(256), 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x41]) for _ in range(10))
        assert decoder.decode([ranks[bytes([b])] for b in data]) == data.decode("utf-8", "replace")


# fingerprints

def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_fingerprints_and_neighbours(documents, odd, nothing):
    draw = random.Random(2)
    for _ in range(300):
        a, b = ("".join(draw.choice("abcd") for _ in range(draw.randint(0, 64))) for _ in range(2))
        assert fuzzyhash.edit_distance(a, b) == levenshtein(a, b)
    rows = {r["doc_id"]: r for r in fuzzyhash.compare_edited(documents).collect()}
    order = sorted(((r["doc_id"], r["text"] or "") for r in documents.collect()), reverse=True)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        new = fuzzyhash.edited(text, following)
        mark, new_mark = fuzzyhash.fingerprint(text.encode()), fuzzyhash.fingerprint(new.encode())
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"]) == (len(text), hashlib.sha256(new.encode()).hexdigest(), mark)
        assert r["edited_fingerprint"] == new_mark and r["near_edited"] == fuzzyhash.likeness(mark, new_mark)
        assert r["near_next"] == fuzzyhash.likeness(mark, fuzzyhash.fingerprint(following.encode()))
    assert np.mean([r["near_edited"] > 0.4 for r in rows.values()]) > 0.95
    assert ids(fuzzyhash.compare_edited(odd)) == ALL_IDS
    assert fuzzyhash.compare_edited(nothing).count() == 0
    assert fuzzyhash.likeness("3::", "3::") == 1.0


# quality

def test_quality_against_labels(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.score_documents(docs).join(labels, "doc_id").toPandas()
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert good.keep.mean() > 0.99 and bad.keep.mean() < 0.1
    assert ids(quality.score_documents(odd)) == ALL_IDS
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(nothing).count() == quality.score_documents(nothing).count() == 0


def test_estimation_finds_precise_labellers():
    rates, shares, posterior = quality.estimate({0: 5, 1: 900, 2: 60, 1 + 3 * quality.BAD: 40})
    assert posterior[1] > quality.KEEP > max(posterior[2], posterior[1 + 3 * quality.BAD])
    assert posterior[0] == 1.0 and abs(shares.sum() - 1) < 1e-9 and (rates[:, 0] <= quality.FALSE_ALARM).all()


# urls

def test_rules_and_trees(spark, sf_dir):
    rules = [urls.Rule(urls.ALLOW, "org/"), urls.Rule(urls.BLOCK, "example.org/es/"), urls.Rule(urls.BLOCK, "example.org/en/1")]
    rows = [(1, "https://A.Example.ORG/es/1?x=1"), (2, "http://org/"), (3, "https://example.org"), (4, None), (5, "no scheme/es/"),
            (6, "https://xorg/es/"), (7, "HTTP://www.example.org/en/12#f"), (7, "HTTP://www.example.org/en/12#f"), (None, "ftp://org/a?b://c")]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    got = [(r["page_id"], r["host"], r["path"], r["rule"]) for r in out]
    assert sorted(got, key=str) == sorted([
        (1, "a.example.org", "/es/1", "example.org/es/"), (2, "org", "/", "org/"), (3, "example.org", "", None), (4, "", "", None),
        (5, "", "", None), (6, "xorg", "/es/", None), (7, "www.example.org", "/en/12", "example.org/en/1"),
        (7, "www.example.org", "/en/12", "example.org/en/1"), (None, "org", "/a", "org/")], key=str)
    assert {r["verdict"] for r in out if r["rule"] is None} <= {urls.ALLOW, urls.BLOCK}
    assert {r["verdict"] for r in out if r["page_id"] in (1, 7)} == {urls.BLOCK}
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    draw = random.Random(1)
    pages = [(i, f"http://h{draw.randrange(9)}.{'bad' if i % 2 else 'good'}.{'xx' if i % 2 else 'yy'}/" + ("1" * 20 if i % 2 else "abc")) for i in range(200)]
    learnt = urls.judge(spark.createDataFrame(pages, "page_id long, url string"),
                        [urls.Rule(urls.BLOCK, "h1.bad.xx/"), urls.Rule(urls.ALLOW, "h2.good.yy/")]).collect()
    assert np.mean([(r["verdict"] == urls.BLOCK) == bool(r["page_id"] % 2) for r in learnt]) > 0.95


# personal data

def test_surrogates_keep_form_and_identity(spark, odd, nothing):
    text = ("Mr. John Smith met Anna Kovacs at 10.0.0.1 and +1 (017) 555-7713, mail john.smith@mail4.example.com or "
            "4111111111111111 card. Later Mr. John Smith left. Иван Петров 123-45-6789 and 0b96a8c8d79c4a5085c919698889f59b72ab7bb6.")
    docs = spark.createDataFrame([(1, text, "x"), (2, "John Smith wrote to 10.0.0.1", "y")], "doc_id long, text string, entities string")
    out = {r["doc_id"]: r for r in pii.replace_entities(docs, "key").collect()}
    kinds = [e["kind"] for e in out[1]["entities"]]
    assert kinds == ["name", "name", "ip", "phone", "email", "card", "name", "name", "ssn", "secret"]
    new = out[1]["text"]
    for r in out.values():
        assert all(r["text"][e["start"] : e["start"] + e["length"]] == e["surrogate"] for e in r["entities"])
    by_kind = {e["kind"]: e["surrogate"] for e in out[1]["entities"]}
    for old in ("John", "Smith", "Anna", "Kovacs", "10.0.0.1", "555-7713", "john.smith", "4111111111111111", "Иван", "123-45-6789", "0b96a8c8"):
        assert old not in new
    assert new.startswith("Mr. ") and out[1]["entities"][0]["surrogate"] == out[1]["entities"][6]["surrogate"]
    assert out[2]["entities"][0]["surrogate"] == out[1]["entities"][0]["surrogate"].removeprefix("Mr. ")
    assert out[2]["entities"][1]["surrogate"] == by_kind["ip"] and all(0 <= int(o) < 256 for o in by_kind["ip"].split("."))
    assert by_kind["phone"].startswith("+1 (") and by_kind["email"].endswith(".com")
    digits = [int(c) for c in by_kind["card"]][::-1]
    assert sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0
    assert out[1]["entities"][0]["surrogate"].split()[1] in pii.GIVEN_NAMES["male latin"]
    assert out[1]["entities"][1]["surrogate"].split()[0] in pii.GIVEN_NAMES["female latin"]
    assert sorted(ids(pii.replace_entities(odd, "key")), key=str) == sorted(ALL_IDS, key=str)
    same = {(r["doc_id"], r["text"]) for r in odd.collect()}
    assert {(r["doc_id"], r["text"]) for r in pii.replace_entities(odd, "key", entities=None).collect()} == same
    assert pii.replace_entities(nothing, "key").count() == 0


def test_surrogates_are_a_permutation(spark):
    every = spark.range(10_000).select(F.format_string("%04d", "id").alias("value"))
    made = every.select("value", pii._in_format(F.col("value"), "k").alias("s"))
    assert made.select("s").distinct().count() == 10_000
    assert made.filter("value = s or length(s) <> 4").count() == 0
    mails = spark.range(3000).select(F.concat(F.col("id").cast("string"), F.lit(" a."), F.col("id"), F.lit("@mail"), F.col("id") % 10, F.lit(".example.com")).alias("text"))
    assert pii.collisions(mails, "k").count() == 0


def test_surrogates_depend_on_the_key(spark):
    one = spark.createDataFrame([("10.1.2.3",)], "v string")
    assert one.select(pii.surrogate(F.col("v"), "a") != pii.surrogate(F.col("v"), "b")).first()[0]
