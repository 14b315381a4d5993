"""Token counts of a byte-level BPE vocabulary by compiled finite-state transducers.

Two deterministic machines stand for the tokenizer:

* The splitter cuts text into pre-tokens. Whether a pre-token starts at a
  character depends on the classes of one character before and three after it (a
  definite automaton), so its transition table is applied to all positions of
  a batch at once.
* The merger reads the bytes of a pre-token and knows after each byte how many
  tokens the bytes so far have. Its state holds, for each end of the text that may
  still grow into a token, the last token before that end and the difference in
  counts; reading a byte finds the one token that ends there and is compatible
  with the token before it. States and transitions are compiled when first met,
  and each transition is annotated with the number of tokens it emits (negative
  when a merge takes tokens back).

Text is cut into chunks of equal length, wherever the cuts fall. A pre-token start
resets the merger, so the state map of a chunk that has one is constant behind
its first start: that part runs for all chunks in lockstep. An exclusive scan
over the maps then gives each chunk its entry state, the heads run from it, and
a segmented sum composes the emitted counts to documents. Chunks without any
start (one huge pre-token) pass their entry state on, one round per chunk.

Special tokens inside a text are handled as the library does by default: each
occurrence is one token and splits the text. Counts equal the library's.

Defined results: NULL counts as the empty text (0 tokens); texts of any length are counted
whole; empty tables give empty results; repeated rows are counted each (there are no
ties); all other columns pass through, and one named like the output is replaced.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import read_table

# Characters of one lockstep run and bytes of a chunk.
RUN_CHARS = 1 << 21
CHUNK = 512
# What a worker holds at most: compiled states (about 0.25 KB each with their
# transitions) and known pairs of tokens. Beyond it the machine starts anew with
# the states in use; counts don't depend on it.
MAX_STATES = 400_000
MAX_PAIRS = 500_000
START = 0
END = struct.Struct("<Bih")

# Character classes of the splitter.
OTHER, LETTER, NUMBER, SPACE, GAP = range(5)
# Fixed values of the vocabulary's splitting rule: what may follow an apostrophe.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: itself
    where it is one, else the next free character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Splitter:
    def __init__(self) -> None:
        self.classes = np.zeros(0x110000, dtype=np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (GAP, r"\s+")):
            for m in regex.finditer(pattern, every):
                self.classes[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
        self.classes[0xD800:0xE000] = OTHER
        self.classes[ord(" ")] = SPACE

    def starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a pre-token starts at each character; ``first``: a text does."""
        n = len(points)
        kind = self.classes[points]
        last = np.r_[first[1:], True]
        blank = kind >= SPACE
        before = np.r_[np.uint8(OTHER), kind[:-1]]
        after_blank = np.r_[blank[1:], True] | last  # or the end of the text
        blank_before = before >= SPACE
        out = np.where(
            blank,
            ~blank_before | ~after_blank,
            np.where(blank_before, before != SPACE, before != kind),
        ) | first
        quote = np.flatnonzero((points == ord("'")) & out & ~last)
        one = points[quote + 1]
        short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
        more = ~short & ~last[quote + 1]
        two = points[np.minimum(quote + 2, n - 1)]
        long = more & np.logical_or.reduce([(one == ord(e[0])) & (two == ord(e[1])) for e in LONG_ENDINGS])
        for length, at in ((2, quote[short]), (3, quote[long])):
            for i in range(1, length):
                out[at + i] = False
            end = at[at + length < n] + length
            out[end] = True
        return out


class Merger:
    """The lazily compiled transducer over the bytes of a pre-token.

    A state is kept as packed bytes: the open text, then for each open end its
    distance, the last token before it and the count there less the count here.
    Transitions are in a hash table of flat arrays, keyed by state and byte.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: dict[tuple[int, int], tuple[int, int]]) -> None:
        self.ids = vocabulary
        self.merges = merges
        self.bytes_of = {i: t for t, i in vocabulary.items()}
        self.single = [vocabulary[bytes([b])] for b in range(256)]
        self.growing = {t[:i] for t in vocabulary for i in range(1, len(t))}
        self.longest = max(map(len, vocabulary))
        self.pairs: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.start = self._pack(b"", [(0, -1, 0)])
        self.states, self.number = [self.start], {self.start: START}
        self.filled = 0
        self._table(1 << 16)

    @staticmethod
    def _pack(open_bytes: bytes, ends: list[tuple[int, int, int]]) -> bytes:
        return bytes([len(open_bytes)]) + open_bytes + b"".join([END.pack(*e) for e in ends])

    def _table(self, size: int) -> None:
        self.keys = np.full(size, -1, dtype=np.int64)
        self.targets = np.zeros(size, dtype=np.int32)
        self.emits = np.zeros(size, dtype=np.int16)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the empty slot where its search ends."""
        mask = len(self.keys) - 1
        slot = ((keys * 0x9E3779B97F4A7C1) >> 20) & mask
        search = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        while len(search):
            slot[search] = (slot[search] + 1) & mask
            there = self.keys[slot[search]]
            search = search[(there != keys[search]) & (there >= 0)]
        return slot

    def _place(self, keys: np.ndarray, targets: np.ndarray, emits: np.ndarray) -> None:
        while len(keys):  # of new keys that end at one empty slot, one takes it and the rest search on
            slot = self._slots(keys)
            self.keys[slot] = keys
            won = self.keys[slot] == keys
            self.targets[slot[won]], self.emits[slot[won]] = targets[won], emits[won]
            keys, targets, emits = keys[~won], targets[~won], emits[~won]

    def _store(self, keys: list[int], targets: list[int], emits: list[int]) -> None:
        self.filled += len(keys)
        if 2 * self.filled > len(self.keys):
            old = np.flatnonzero(self.keys >= 0)
            held = self.keys[old], self.targets[old], self.emits[old]
            self._table(1 << (4 * self.filled).bit_length())
            self._place(*held)
        self._place(np.array(keys, np.int64), np.array(targets, np.int32), np.array(emits, np.int16))

    def _together(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens as they are, side by side."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            merges = self.merges
            parts = [self.single[b] for b in self.bytes_of[left] + self.bytes_of[right]]
            while len(parts) > 1:
                _, i, joined = min([(merges[p][0], i, merges[p][1]) for i, p in enumerate(zip(parts, parts[1:])) if p in merges], default=(0, -1, 0))
                if i < 0:
                    break
                parts[i : i + 2] = [joined]
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = parts == [left, right]
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The state that follows, and the tokens emitted."""
        packed = self.states[state]
        cut = 1 + packed[0]
        window = {d: (token, count) for d, token, count in END.iter_unpack(packed[cut:])}
        grown = packed[1:cut] + bytes([byte])
        size = len(grown)
        for distance in sorted(window, reverse=True):
            token = self.ids.get(grown[size - 1 - distance :])
            if token is not None:
                last, count = window[distance]
                if last < 0 or self._together(last, token):
                    break
        else:
            raise ValueError("the vocabulary lacks single bytes")
        emitted = count + 1
        ends, longest = [(0, token, 0)], b""
        for distance in sorted(window):
            suffix = grown[size - 1 - distance :]
            if suffix in self.growing:
                last, count = window[distance]
                ends.append((distance + 1, last, count - emitted))
                longest = suffix
        after = self._pack(longest, ends)
        target = self.number.get(after)
        if target is None:
            target = self.number[after] = len(self.states)
            self.states.append(after)
        return target, emitted

    def run(self, data: np.ndarray, resets: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read data[begin:end] of every lane from its state; exit states and emitted counts."""
        order = np.argsort(begin - end, kind="stable")  # longest first: the lanes still reading are a prefix
        at, state, lengths = begin[order].copy(), state[order].astype(np.int64), (end - begin)[order]
        total = np.zeros(len(at), dtype=np.int64)
        reading = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")
        for n in reading:
            if len(self.states) > MAX_STATES:
                state = self._restart(state)
            key = np.where(resets[at[:n]], START, state[:n]) << 8 | data[at[:n]]
            slot = self._slots(key)
            missing = np.flatnonzero(self.keys[slot] < 0)
            if len(missing):
                fresh = np.unique(key[missing]).tolist()
                self._store(fresh, *zip(*(self.compile(k >> 8, k & 255) for k in fresh)))
                slot = self._slots(key)
            total[:n] += self.emits[slot]
            state[:n] = self.targets[slot]
            at[:n] += 1
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def packed(self, state: np.ndarray) -> list[bytes]:
        """States by what they hold: their numbers are good until a restart only."""
        return [self.states[s] for s in state.tolist()]

    def numbers(self, packed: list[bytes]) -> np.ndarray:
        for p in packed:
            if p not in self.number:
                self.number[p] = len(self.states)
                self.states.append(p)
        return np.array([self.number[p] for p in packed], dtype=np.int64)

    def _restart(self, state: np.ndarray) -> np.ndarray:
        """Forget all but the states in use; their new numbers."""
        used, flat = np.unique(state, return_inverse=True)
        kept = [self.states[s] for s in used]
        self._clear()
        for s in kept:
            if s not in self.number:
                self.number[s] = len(self.states)
                self.states.append(s)
        return np.array([self.number[s] for s in kept], dtype=np.int64)[flat]


class Transducer:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_of()
        as_bytes = {s: bytes(byte_of[c] for c in s) for s in spec["model"]["vocab"] if all(c in byte_of for c in s)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        ids = {as_bytes[s]: i for s, i in spec["model"]["vocab"].items() if s in as_bytes and s not in self.specials}
        merges = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            merges.setdefault((ids[as_bytes[a]], ids[as_bytes[b]]), (rank, ids[as_bytes[a] + as_bytes[b]]))
        self.splitter = Splitter()
        self.merger = Merger(ids, merges)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(texts), dtype=np.int64)
        pieces, owner = [], []
        for i, text in enumerate(texts):
            parts = [text]
            for special in self.specials:
                if special in text:
                    total[i] += text.count(special) if len(parts) == 1 else sum(p.count(special) for p in parts)
                    parts = [q for p in parts for q in p.split(special)]
            for p in parts:
                if p:
                    pieces.append(p)
                    owner.append(i)
        first = 0
        while first < len(pieces):
            last, size = first, 0
            while last < len(pieces) and (last == first or size + len(pieces[last]) <= RUN_CHARS):
                size += len(pieces[last])
                last += 1
            np.add.at(total, owner[first:last], self._run(pieces[first:last]))
            first = last
        return total

    def _run(self, pieces: list[str]) -> np.ndarray:
        joined = "".join(pieces)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(p) for p in pieces])
        first = np.zeros(len(points), dtype=bool)
        first[np.cumsum(lengths) - lengths] = True
        starts = self.splitter.starts(points, first)
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of every character
        resets = np.zeros(len(data) + 1, dtype=bool)
        resets[lead[starts]] = True
        # Chunks of equal length within each piece.
        begins = lead[np.flatnonzero(first)]
        ends = np.r_[begins[1:], len(data)]
        n = -(-(ends - begins) // CHUNK)
        piece = np.repeat(np.arange(len(pieces)), n)
        begin = begins[piece] + CHUNK * (np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n))
        end = np.minimum(begin + CHUNK, ends[piece])
        # Where each chunk's map turns constant: its first reset.
        marks = np.flatnonzero(resets)
        at = np.searchsorted(marks, begin)
        constant = np.where(at < len(marks), marks[np.minimum(at, len(marks) - 1)], len(data))
        constant = np.minimum(constant, end)
        has = constant < end
        emitted = np.zeros(len(begin), dtype=np.int64)
        out, emitted[has] = self.merger.run(data, resets, constant[has], end[has], np.zeros(int(has.sum()), dtype=np.int64))
        waiting = np.flatnonzero(constant > begin)
        if len(waiting):
            exits = dict(zip(np.flatnonzero(has).tolist(), self.merger.packed(out)))
            emitted[waiting] += self._heads(data, resets, begin, constant, has, exits, waiting)
        return np.bincount(piece, weights=emitted, minlength=len(pieces)).astype(np.int64)

    def _heads(
        self, data: np.ndarray, resets: np.ndarray, begin: np.ndarray, constant: np.ndarray, has: np.ndarray, exits: dict[int, bytes],
        waiting: np.ndarray,
    ) -> np.ndarray:
        """Tokens emitted by the parts of chunks before their first reset, whose entry state is the
        exit state of the chunk before.

        A chunk without a reset is a state map. Maps are kept as far as they are known: by
        chunk (equal bytes share one) and entry state. First every chunk is read from the exit that
        its predecessor has when begun anew, all in lockstep. Then adjacent maps are composed pairwise, in
        blocks of 1, 2, 4, ... chunks: where the left block's exit is not the state that the right
        one was read from, the right one is read again from there until it meets a known
        state. A merger forgets its entry after a few tokens, so mostly the first chunk does.
        """
        known: dict[tuple[bytes, bytes], tuple[bytes, int]] = {}
        content = {i: data[begin[i] : constant[i]].tobytes() for i in waiting.tolist()}

        def read(chunks: list[int], states: list[bytes]) -> list[tuple[bytes, int]]:
            keys = [(content[i], s) for i, s in zip(chunks, states)]
            new = {k: i for k, i in zip(keys, chunks) if k not in known}
            if new:
                at = np.fromiter(new.values(), dtype=np.int64)
                out, more = self.merger.run(data, resets, begin[at], constant[at], self.merger.numbers([s for _, s in new]))
                known.update(zip(new, zip(self.merger.packed(out), more.tolist())))
            return [known[k] for k in keys]

        chunks = waiting.tolist()
        first = [i for i in chunks if has[i - 1]]
        later = [i for i in chunks if not has[i - 1]]
        entry = {i: exits[i - 1] for i in first}
        entry |= zip(later, (s for s, _ in read([i - 1 for i in later], [self.merger.start] * len(later))))
        emitted: dict[int, int] = {}

        def settle(some: list[int]) -> None:
            for i, (state, n) in zip(some, read(some, [entry[i] for i in some])):
                emitted[i] = n
                if not has[i]:
                    exits[i] = state

        settle(chunks)
        # Places in the chains of chunks that wait for each other.
        place: dict[int, int] = {}
        for i in chunks:
            place[i] = 0 if has[i - 1] else place[i - 1] + 1
        size, longest = 1, max(place.values())
        while size <= longest:
            ask = [i for i in later if place[i] % (2 * size) == size]
            ends = {i: i + size for i in ask}
            while ask:
                ask = [i for i in ask if entry[i] != exits[i - 1]]
                entry |= {i: exits[i - 1] for i in ask}
                settle(ask)
                # On into the right block, as far as it reaches and nothing is known to fit.
                on = {i + 1: ends[i] for i in ask if i + 1 < ends[i] and i + 1 in place and place[i + 1] == place[i] + 1}
                ask, ends = list(on), on
            size *= 2
        return np.array([emitted[i] for i in chunks], dtype=np.int64)


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The compiled machine of a vocabulary file, kept by the Python worker."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def with_token_count(docs: DataFrame, text_col: str, out: str, path: str) -> DataFrame:
    """``docs`` plus the number of tokens of ``text_col`` (BIGINT) under the
    byte-level BPE vocabulary at ``path`` (a file every executor has)."""

    @pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = transducer(path)
        for texts in batches:
            yield pd.Series(machine.counts(["" if t is None else t for t in texts]))

    return docs.withColumn(out, tokens(F.col(text_col)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; ``over_limit``: more than 512."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_token_count(docs, "text", "n_tokens", public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )
