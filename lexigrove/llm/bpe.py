"""Byte-level BPE as a lazily determinised transducer, and its streaming inverse.

Encoding. Within one match of the split pattern, a text has exactly one BPE token sequence, and a sequence is that
one if every two neighbours are what merging yields for their joined bytes. Reading left to right, a hypothesis is
*the last token so far plus the bytes of a token still open*, the latter a node of a trie. The sets of open nodes are the states of a subset
construction, made with their transitions when first met; as the longest open node has the others as suffixes, there are no more states than nodes.
The last tokens stand in registers, one a byte of the lookahead, so they don't multiply the states: a transition names the tokens that end with
its byte, and the one that fits to the register where it starts is the next register. The sequence is read off the registers
backwards, at the end or, in a long match, once a block as far as all hypotheses share it. The distinct matches of a few megabytes of
text are read in step, a byte of each at a time, with the transitions in arrays.

Decoding. The state machine for UTF-8 reads bytes; over tokens it is determinised in the same lazy way, so a token
seen before in the same state costs one lookup. A sequence cut in the middle of a character stays in the state until the
next token; malformed bytes become U+FFFD.

Null, empty and repeated rows: a null text counts as empty and gives an empty list; every input row gives one output row;
columns of the input are passed on, and an existing column with the output's name is replaced.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

#: Bounds of the tables each task keeps; a full table is emptied, which costs time and changes no result.
MAX_STATES, MAX_WORDS, MAX_WORD_CHARS = 250_000, 300_000, 64
#: The next state, tokens that end with the byte and their sizes, longest first; the same again, but none if one of them is irregular.
Move = tuple[int, tuple[tuple[int, int], ...], tuple[tuple[int, int], ...]]
#: Bytes of a match after which the tokens that are certain are emitted and their registers freed.
BLOCK = 4096
#: Text whose matches are looked at together.
PART_BYTES = 2_000_000


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; read once by the driver and sent to the tasks (under 1 MB)."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    ranks = {}
    for line in raw.splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


def merge_pieces(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain definition: join the neighbours of lowest rank, leftmost first, until none can be joined."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


#: The rank at which a token's edge ends that nothing inside the token ends.
NEVER = 1 << 40


class Transducer:
    """Reads the bytes of one match, emits token ids after bounded lookahead."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        # prefixes of tokens as a trie: node 0 is the empty one, a child's key is its parent and the byte
        self.child: dict[int, int] = {}
        self.token_at, self.longer, self.depth = [-1], bytearray(1), array("l", [0])
        for token, rank in ranks.items():
            node = 0
            for depth, byte in enumerate(token, 1):
                key = node << 8 | byte
                below = self.child.get(key)
                if below is None:
                    below = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.longer.append(0)
                    self.depth.append(depth)
                    self.longer[node] = 1
                node = below
            self.token_at[node] = rank
        self.edges: dict[int, tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None] = {}
        self.after: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.known = 0
        self._reset()

    def _reset(self) -> None:
        # open nodes of a state, its number by the longest of them; the root, where a token begins, is open in all
        self.states: list[tuple[int, ...]] = [()]
        self.numbers = {0: 0}
        self.moves: list[dict[int, Move]] = [{}]
        self.made = 0

    def edges_of(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None:
        """What stands at the left and the right edge while the token's bytes are merged, each with the rank of the merge that ends it.

        None for a token that merging does not yield, or not by merges of rising rank.
        """
        if token not in self.edges:
            whole = self.bytes_of[token]
            parts = [whole[i : i + 1] for i in range(len(whole))]
            left, right, before = [], [], -1
            while len(parts) > 1:
                joins = [self.ranks.get(a + b, NEVER) for a, b in pairwise(parts)]
                rank = min(joins)
                if rank == NEVER or rank < before:
                    break
                at, before = joins.index(rank), rank
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            regular = len(parts) == 1
            self.edges[token] = ([*left, (whole, NEVER)], [*right, (whole, NEVER)]) if regular else None
        return self.edges[token]

    def _side_by_side(self, left: int, right: int) -> bool:
        """No two neighbours at the boundary are joined before either is joined with something on its own side.

        Both sides merge by rising rank and on their own until a join crosses the boundary, so it is enough to look at what
        stands at it at the same time; of joins of one rank the leftmost comes first.
        """
        before, after = self.edges_of(left), self.edges_of(right)
        if before is None or after is None:
            return merge_pieces(self.bytes_of[left] + self.bytes_of[right], self.ranks) == [left, right]
        ranks, i, j = self.ranks, 0, 0
        before, after = before[1], after[0]
        while True:
            (a, a_ends), (b, b_ends) = before[i], after[j]
            joined = ranks.get(a + b, NEVER)
            if joined < a_ends and joined <= b_ends:
                return False
            if a_ends == b_ends == NEVER:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def joins(self, left: int, right: int) -> bool:
        """``fits``, worked out."""
        if left >= 0:
            return self._side_by_side(left, right)
        return self.edges_of(right) is not None or merge_pieces(self.bytes_of[right], self.ranks) == [right]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of both tokens gives these two tokens."""
        known = self.after[left].get(right)
        if known is None:
            if self.known >= MAX_STATES:
                self.after.clear()
                self.known = 0
            known = self.joins(left, right)
            self.after[left][right] = known
            self.known += 1
        return known

    def step(self, state: int, byte: int) -> Move:
        """Make the transition. Nodes stand by falling depth; of regular tokens the first that fits is the only one."""
        reached, ended = [], []
        for node in (*self.states[state], 0):
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            if self.longer[below]:
                reached.append(below)
            if self.token_at[below] >= 0:
                ended.append((self.token_at[below], self.depth[below]))
        longest = reached[0] if reached else 0
        target = self.numbers.get(longest)
        if target is None:
            target = self.numbers[longest] = len(self.states)
            self.states.append(tuple(reached))
            self.moves.append({})
        regular = all(self.edges_of(token) is not None for token, _ in ended)
        move = self.moves[state][byte] = (target, tuple(ended), tuple(ended) if regular else ())
        self.made += 1
        return move

    def _emit(self, registers: list[int], at: int) -> list[int]:
        """The tokens up to register ``at``."""
        out, sizes = [], self.sizes
        while at > 0:
            token = registers[at]
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def _certain(self, registers: list[int], state: int) -> int:
        """The last register that the sequences of all hypotheses go through."""
        end = len(registers) - 1
        starts = {end, *(end - self.depth[node] for node in self.states[state])}
        while len(starts) > 1:
            last = max(starts)
            starts.remove(last)
            starts.add(last - self.sizes[registers[last]])
        return starts.pop()

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if self.made > MAX_STATES:
            self._reset()
        out: list[int] = []
        # the last token up to each byte of what isn't emitted yet, and what is known to fit to it; the first stands before all of it
        state, moves, after = 0, self.moves, self.after
        registers, rows = [-1], [after[-1]]
        for start in range(0, len(piece), BLOCK):
            if start:
                at = self._certain(registers, state)
                out += self._emit(registers, at)
                del registers[:at], rows[:at]
            for byte in piece[start : start + BLOCK]:
                state, ended, regular = moves[state].get(byte) or self.step(state, byte)
                for token, size in regular:
                    fits = rows[-size].get(token)
                    if fits or fits is None and self.fits(registers[-size], token):
                        break
                else:  # not met with the vocabularies here; where the sequence isn't unique the definition decides
                    fitting = [token for token, size in ended if self.fits(registers[-size], token)]
                    if len(fitting) != 1:
                        return tuple(merge_pieces(piece, self.ranks))
                    token = fitting[0]
                registers.append(token)
                rows.append(after[token])
        out += self._emit(registers, len(registers) - 1)
        return tuple(out)


def _grown(values: np.ndarray, wanted: int) -> np.ndarray:
    if wanted <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(wanted, 2 * len(values)) - len(values), values.dtype)])


class Lockstep:
    """The transducer over many matches at a time: all read their first byte, then their second, and so on.

    Its transitions stand in arrays, what fits to what in a table of slots. Matches that are long, or at which the transducer
    would fall back on the definition, are left to it one by one.
    """

    #: Matches read together, and their longest in bytes.
    ROWS, LONGEST = 1 << 16, 64
    SLOT_BITS = 20
    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        self.width = max(transducer.bytes_of, default=0) + 2
        self.sizes = np.zeros(self.width, np.int32)
        for rank, size in transducer.sizes.items():
            self.sizes[rank] = size
        self._empty_slots()
        self._empty_moves()

    def _empty_slots(self) -> None:
        # a key and, in the last bit, whether its tokens fit; 0 is a free slot
        self.slots, self.known = np.zeros(1 << self.SLOT_BITS, np.uint64), 0

    def _empty_moves(self) -> None:
        self.states = self.transducer.states
        # by state and byte the number of the move, 0 where it isn't made; pages that are never written take no memory
        self.number = np.zeros((sum(self.transducer.longer) + 1, 256), np.int32)
        self.target, self.first, self.last = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.tokens, self.lengths = np.zeros(4096, np.int32), np.zeros(4096, np.int32)
        self.moves, self.listed = 1, 0

    def _make(self, keys: np.ndarray) -> None:
        for state, byte in zip((keys >> 8).tolist(), (keys & 255).tolist(), strict=True):
            move = self.transducer.moves[state].get(byte) or self.transducer.step(state, byte)
            at, ended = self.moves, move[2]
            self.target, self.first, self.last = (_grown(v, at + 1) for v in (self.target, self.first, self.last))
            self.tokens, self.lengths = (_grown(v, self.listed + len(ended) + 1) for v in (self.tokens, self.lengths))
            self.target[at], self.first[at], self.last[at] = move[0], self.listed, self.listed + len(ended)
            for token, size in ended:
                self.tokens[self.listed], self.lengths[self.listed] = token, size
                self.listed += 1
            self.number[state, byte] = at
            self.moves += 1

    def _slots_of(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free one where it would stand."""
        slots = (keys * self.SPREAD >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        held = self.slots[slots] >> np.uint64(1)
        other = np.flatnonzero((held != keys) & (held != 0))
        while len(other):
            slots[other] = (slots[other] + 1) & (len(self.slots) - 1)
            held = self.slots[slots[other]] >> np.uint64(1)
            other = other[(held != keys[other]) & (held != 0)]
        return slots

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) + 1) * self.width + right + 1
        keys = keys.astype(np.uint64)
        found = self.slots[self._slots_of(keys)]
        unknown = np.flatnonzero(found == 0)
        if len(unknown):
            fresh, at = np.unique(keys[unknown], return_index=True)
            if self.known + len(fresh) > MAX_STATES:
                self._empty_slots()
            at = unknown[at]
            fits = map(self.transducer.joins, left[at].tolist(), right[at].tolist())
            held = fresh << np.uint64(1) | np.fromiter(fits, np.uint64, len(at))
            mask, slots, put = len(self.slots) - 1, self.slots, (fresh * self.SPREAD >> np.uint64(64 - self.SLOT_BITS)).tolist()
            for slot, value in zip(put, held, strict=True):
                while slots[slot]:
                    slot = (slot + 1) & mask
                slots[slot] = value
            self.known += len(fresh)
            found[unknown] = held[np.searchsorted(fresh, keys[unknown])]
        return found & np.uint64(1) != 0

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` (large strings, none of them null) one after the other, and how many each has."""
        if not len(words):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        parts = [self._part(data, offsets[at : at + self.ROWS + 1]) for at in range(0, len(words), self.ROWS)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    def _part(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.transducer.made > MAX_STATES:
            self.transducer._reset()
        if self.transducer.states is not self.states:
            self._empty_moves()
        sizes = np.diff(offsets)
        alone = sizes > self.LONGEST
        # the longest first, so that those which still have bytes are always the first ones
        order = np.argsort(np.where(alone, 0, -sizes), kind="stable")
        begins, left = offsets[:-1][order], np.where(alone, 0, sizes)[order]
        bad = alone[order]
        longest = int(left.max(initial=0))
        registers = np.full((longest + 1, len(order)), -1, np.int32)
        state = np.zeros(len(order), np.int64)
        for at in range(longest):
            reading = int(np.searchsorted(-left, -at, side="left"))
            keys = state[:reading] << 8 | data[begins[:reading] + at]
            moves = self.number.ravel()[keys]
            if not moves.all():
                self._make(np.unique(keys[moves == 0]))
                moves = self.number.ravel()[keys]
            state[:reading] = self.target[moves]
            row, todo, tried, until = registers[at + 1], np.arange(reading), self.first[moves], self.last[moves]
            while True:
                out = tried >= until
                if out.any():
                    # it reads on as if it began here, but its result is not used
                    bad[todo[out]] = True
                    todo, tried, until = todo[~out], tried[~out], until[~out]
                if not len(todo):
                    break
                token = self.tokens[tried]
                fits = self._fit(registers[at + 1 - self.lengths[tried], todo], token)
                row[todo[fits]] = token[fits]
                open_ = ~fits
                todo, tried, until = todo[open_], tried[open_] + 1, until[open_]
        return self._read_off(data, offsets, order, left, registers, bad)

    def _read_off(
        self, data: np.ndarray, offsets: np.ndarray, order: np.ndarray, left: np.ndarray, registers: np.ndarray, bad: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The sequences backwards from their last registers, in the order of the matches."""
        counts, steps = np.zeros(len(order), np.int64), []
        at, rows = left.astype(np.int64), np.flatnonzero((left > 0) & ~bad)
        while len(rows):
            token = registers[at[rows], rows]
            steps.append((rows, token))
            counts[rows] += 1
            at[rows] -= self.sizes[token]
            rows = rows[at[rows] > 0]
        single = {}
        for row in np.flatnonzero(bad).tolist():
            start, end = offsets[order[row]], offsets[order[row] + 1]
            single[row] = self.transducer.encode(data[start:end].tobytes())
            counts[row] = len(single[row])
        given = np.empty_like(counts)
        given[order] = counts
        ends = np.cumsum(given)
        last = ends[order]
        ids = np.empty(int(given.sum()), np.int32)
        for back, (rows, token) in enumerate(steps, 1):
            ids[last[rows] - back] = token
        for row, tokens in single.items():
            ids[last[row] - len(tokens) : last[row]] = tokens
        return ids, given


class _Words(dict):
    """Ids of whole matches seen before."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.transducer.encode(word.encode("utf-8", "surrogatepass"))
        if len(word) <= MAX_WORD_CHARS:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, raw_ranks: bytes, pattern: str):
        self.words = _Words(Transducer(parse_ranks(raw_ranks)))
        self.many = Lockstep(self.words.transducer)
        self.matches = regex.compile(pattern).findall

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.words.__getitem__, self.matches(text))))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and from where to where each text's are; equal matches are encoded once."""
        found, counts = [], []
        for text in texts:
            matches = self.matches(text.as_py() or "")
            counts.append(len(matches))
            found.append(pa.array(matches, pa.large_string()))
        places = pa.chunked_array(found, pa.large_string()).combine_chunks().dictionary_encode()
        flat, sizes = self.many.encode(places.dictionary)
        met = places.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[met])])
        # the ids of a match lie together among those of distinct ones: from its first place there, counted on
        begins = np.cumsum(sizes) - sizes
        ids = flat[np.arange(ends[-1]) + np.repeat(begins[met] - ends[:-1], sizes[met])]
        return ids, ends[np.cumsum([0, *counts])]


#: Ranges of the second byte by lead byte, as the standard lists well-formed sequences (fixed values):
#: lead bytes from, to, bytes that follow, lowest second byte, highest second byte.
WELL_FORMED = (
    (0xC2, 0xDF, 1, 0x80, 0xBF),
    (0xE0, 0xE0, 2, 0xA0, 0xBF),
    (0xE1, 0xEC, 2, 0x80, 0xBF),
    (0xED, 0xED, 2, 0x80, 0x9F),
    (0xEE, 0xEF, 2, 0x80, 0xBF),
    (0xF0, 0xF0, 3, 0x90, 0xBF),
    (0xF1, 0xF3, 3, 0x80, 0xBF),
    (0xF4, 0xF4, 3, 0x80, 0x8F),
)


class Utf8Machine:
    """State: code point so far, bytes missing, range of the next byte. Reads a byte, yields text."""

    START = (0, 0, 0x80, 0xBF)

    def __init__(self) -> None:
        self.leads = {}
        for low, high, missing, second_low, second_high in WELL_FORMED:
            for lead in range(low, high + 1):
                self.leads[lead] = (lead & (0x3F >> missing), missing, second_low, second_high)

    def read(self, state: tuple[int, int, int, int], byte: int) -> tuple[str, tuple[int, int, int, int]]:
        value, missing, low, high = state
        if missing:
            if low <= byte <= high:
                value = value << 6 | byte & 0x3F
                if missing == 1:
                    return chr(value), self.START
                return "", (value, missing - 1, 0x80, 0xBF)
            text, state = self.read(self.START, byte)
            return "�" + text, state
        if byte < 0x80:
            return chr(byte), self.START
        if byte in self.leads:
            return "", self.leads[byte]
        return "�", self.START


class StreamDecoder:
    """Token ids to text, one id at a time; what is no whole character yet stays in the state."""

    def __init__(self, raw_ranks: bytes):
        self.bytes_of = {rank: token for token, rank in parse_ranks(raw_ranks).items()}
        self.machine = Utf8Machine()
        self.moves: dict[tuple[int, int, int, int], dict[int, tuple[str, tuple[int, int, int, int]]]] = {}

    def _make(self, state: tuple[int, int, int, int], token: int) -> tuple[str, tuple[int, int, int, int]]:
        text, after = [], state
        for byte in self.bytes_of[token]:
            piece, after = self.machine.read(after, byte)
            text.append(piece)
        if len(self.moves) > 4096:
            self.moves.clear()
        move = self.moves.setdefault(state, {})[token] = ("".join(text), after)
        return move

    def stream(self, tokens: Iterable[int]) -> Iterator[str]:
        state = self.machine.START
        known = self.moves.setdefault(state, {})
        for token in tokens:
            move = known.get(token) or self._make(state, token)
            yield move[0]
            if move[1] is not state:
                state = move[1]
                known = self.moves.setdefault(state, {})
        if state[1]:
            yield "�"

    def decode(self, tokens: Iterable[int] | None) -> str:
        return "".join(self.stream(tokens or ()))


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a few megabytes of the column's texts or ids, so that a batch of long texts never has all its matches in Python at once."""
    # the tables grow to many small objects without cycles: looking for cycles among them often is in vain
    gc.set_threshold(200_000, 50, 1000)
    for batch in batches:
        values = batch.column(column)
        # an id stands for some four bytes of text
        sizes = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start, before = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start, before = end, ends[end - 1]


def _without(df: DataFrame, output: str) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name.lower() != output.lower()]


def _with_ids(part: pa.RecordBatch, text: str, encoder: Encoder) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Ids of all texts, from where to where each text's are, and both as one Arrow column."""
    ids, ends = encoder.encode_all(part.column(text))
    kind = pa.list_(pa.field("element", pa.int32(), False))
    return ids, ends, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), type=kind)


def encode(df: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", output: str = "token_ids") -> DataFrame:
    """``df`` with the ids of each whole text; no special tokens."""
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = _without(df, output)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(raw.value, pattern)
        for part in _parts(batches, text):
            column = _with_ids(part, text, encoder)[2]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column], [*names, output])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(output, T.ArrayType(T.IntegerType(), False))]))


def round_trip(
    df: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", tokens: str = "token_ids", output: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, so that one worker holds the vocabulary once."""
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [f for f in _without(df, output) if f.name.lower() != tokens.lower()]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decode_one = Encoder(raw.value, pattern), StreamDecoder(raw.value).decode
        for part in _parts(batches, text):
            ids, ends, column = _with_ids(part, text, encoder)
            texts = pa.array((decode_one(ids[a:b].tolist()) for a, b in pairwise(ends.tolist())), pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column, texts], [*names, tokens, output])

    kinds = [T.StructField(tokens, T.ArrayType(T.IntegerType(), False)), T.StructField(output, T.StringType())]
    return df.mapInArrow(run, T.StructType([*kept, *kinds]))


def decode(df: DataFrame, ranks_path: str, *, tokens: str = "token_ids", output: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids; null counts as empty."""
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = _without(df, output)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_one = StreamDecoder(raw.value).decode
        for part in _parts(batches, tokens):
            lists = part.column(tokens)
            texts = (decode_one(v.values.to_numpy().tolist() if v.is_valid else ()) for v in lists)
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], [*names, output])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(output, T.StringType())]))
