"""Neighbours of the transducer against the plain definition of merging."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from lexigrove.llm import bpe
from lexigrove.llm.bpe import Transducer, merge_pieces, parse_ranks, read_ranks


@pytest.fixture(scope="module")
def transducer():
    return Transducer(parse_ranks(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))))


def test_neighbours_by_definition(transducer):
    draw, ranks, bytes_of = random.Random(5), transducer.ranks, transducer.bytes_of
    pairs = [(draw.randrange(len(ranks)), draw.randrange(len(ranks))) for _ in range(5_000)]
    for token in draw.sample(sorted(ranks), 3_000):
        pairs += [(ranks[token[:k]], ranks[token[k:]]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
    pairs = [(a, b) for a, b in pairs if a in bytes_of and b in bytes_of]
    for a, b in pairs:
        assert transducer.fits(a, b) == (merge_pieces(bytes_of[a] + bytes_of[b], ranks) == [a, b])


@pytest.mark.parametrize("seed", range(40))
def test_any_vocabulary(seed):
    """Small random vocabularies, with tokens that merging never yields or whose parts rank behind them."""
    draw = random.Random(seed)
    tokens = [b"a", b"b", b"c"]
    while len(tokens) < 14:
        token = bytes(draw.choice(b"abc") for _ in range(draw.randint(2, 5)))
        if token not in tokens:
            tokens.append(token)
    if seed % 2:
        tokens[3:] = sorted(tokens[3:], key=len)
    built = Transducer({t: i for i, t in enumerate(tokens)})
    for _ in range(300):
        word = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 12)))
        whole = built.ranks.get(word)
        assert built.encode(word) == ((whole,) if whole is not None else tuple(merge_pieces(word, built.ranks)))


def test_no_more_states_than_open_nodes(transducer):
    """Words of frequent parts have many different last tokens, which must not multiply the states."""
    draw, parts = random.Random(9), ["ing", "the", "tion", "ent", "ou", "que", "an", "er", "st", "wh", "ea", "ble", "pa", "re", "un", "is"]
    built = Transducer(transducer.ranks)
    for _ in range(20_000):
        built.encode(("".join(draw.choice(parts) for _ in range(draw.randint(2, 6)))).encode())
    assert len(built.states) <= 1_000


@pytest.mark.parametrize("seed", range(20))
def test_matches_in_step_by_definition(seed, monkeypatch):
    draw = random.Random(seed)
    tokens = [b"a", b"b", b"c"]
    while len(tokens) < 14:
        token = bytes(draw.choice(b"abc") for _ in range(draw.randint(2, 5)))
        if token not in tokens:
            tokens.append(token)
    if seed % 2:
        tokens[3:] = sorted(tokens[3:], key=len)
    if seed % 3 == 0:
        monkeypatch.setattr(bpe, "MAX_STATES", 20)
        monkeypatch.setattr(bpe, "BLOCK", 7)
        monkeypatch.setattr(bpe.Lockstep, "ROWS", 11)
    # ids need not begin at 0
    built = bpe.Lockstep(Transducer({t: i + 5 for i, t in enumerate(tokens)}))
    ranks = built.transducer.ranks
    for _ in range(3):
        words = ["".join(draw.choice("abc") for _ in range(draw.choice([1, 2, 3, 5, 8, 12, 64, 65, 90]))) for _ in range(120)]
        ids, counts = built.encode(pa.array(words, pa.large_string()).slice(3))
        ends = [0, *counts.cumsum().tolist()]
        for word, start, end in zip(words[3:], ends, ends[1:], strict=False):
            whole = ranks.get(word.encode())
            assert ids[start:end].tolist() == ([whole] if whole is not None else merge_pieces(word.encode(), ranks))
    assert [len(v) for v in built.encode(pa.array([], pa.large_string()))] == [0, 0]
