"""SentencePiece encoding and decoding: Viterbi over an Aho-Corasick automaton.

Pieces, scores and the kind of model come from a SentencePiece model file. A text
is normalised as the model says (spaces escaped to U+2581, a dummy prefix). The
automaton over the pieces reads the text once; at each position it follows its
output links to all pieces that end there, each of which relaxes the best score
of that position from the best score where the piece starts.

* Unigram models: a path's score is the sum of its pieces' scores; of equal sums
  the longer last piece wins.
* BPE models: a piece may follow another only where merging by score leaves the
  two side by side (a transition weight of minus infinity otherwise). That leaves
  one path to each position, the one merging gives, so ids equal the library's.
  Unconstrained sums of BPE scores, which are merge ranks, would not.

A character that is no piece costs the smallest score less 10 and becomes its
UTF-8 bytes' pieces (or the unknown piece). If no piece of the model goes on over
the start of a U+2581 run, the best path of a text is that of its words side by
side; words met before are taken from a bounded memory.

Defined results: NULL and empty texts have no pieces and decode to the empty text;
U+2581 in a text decodes as a space; ids outside the model are an error; repeated
rows are encoded each; empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tessera.llm.common import read_table, temp_column

SPACE = "▁"
# Fixed value of the format: what an unknown character costs beyond the worst piece.
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")
# Words (of at most so many characters) whose pieces a worker remembers.
REMEMBER = 200_000
REMEMBER_CHARS = 48
REMEMBER_PAIRS = 250_000


class Pieces:
    def __init__(self, path: str) -> None:
        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        kind = model_pb2.ModelProto.SentencePiece
        self.prefix = spec.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        self.hidden = {i for i, p in enumerate(model.pieces) if p.type in (kind.CONTROL, kind.UNKNOWN)}
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        # What each id shows. ASCII bytes stand for themselves; only longer byte
        # sequences and pieces without text need care.
        self.shown = [p.replace(SPACE, " ") for p in self.pieces]
        for i, b in self.byte_of.items():
            self.shown[i] = chr(b)
        self.special = self.hidden | {i for i, b in self.byte_of.items() if b > 0x7F}
        self.byte_ids = {b: i for i, b in self.byte_of.items()} if model.trainer_spec.byte_fallback else {}
        normal = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED)}
        self.single = {p for p in normal if len(p) == 1}
        self.unknown_score = min(s for _, s in normal.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in normal.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        whole = any(SPACE in p.lstrip(SPACE) for p in normal)
        self.words = re.compile(r"(?s).+" if whole else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        # Words apart by single spaces and newlines can be looked up as they are.
        self.simple = not whole and self.prefix and not any("\n" in p for p in normal)
        self.known = _Known(lambda w: self.segment(w if w[:1] == "\n" else SPACE + w).tobytes())
        # BPE: scores of all pieces, and pairs of pieces known to stay apart or not.
        self.merging = model.trainer_spec.model_type == model_pb2.TrainerSpec.BPE
        self.score_of = {p: score for p, (_, score) in normal.items()}
        self.pairs: dict[int, bool] = {}

    def _apart(self, left: int, right: int) -> bool:
        """Whether merging by score (leftmost first) leaves the two pieces as they are."""
        score_of = self.score_of
        parts = [*self.pieces[left], *self.pieces[right]]
        scores = [score_of.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score_of.get(parts[i - 1] + parts[i], NEVER)
            if i < len(scores):
                scores[i] = score_of.get(parts[i] + parts[i + 1], NEVER)
        if len(self.pairs) >= REMEMBER_PAIRS:
            self.pairs.clear()
        found = self.pairs[left << 32 | right] = len(parts) == 2 and parts[0] == self.pieces[left]
        return found

    def _unknown(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def _merged(self, text: str) -> list[int]:
        """The path of a BPE model through a text whose characters are all pieces:
        only one piece at each position may follow the path to where it starts."""
        n = len(text)
        ids, starts = [-1] * (n + 1), [0] * (n + 1)
        pairs = self.pairs
        for end, (length, _, piece) in self.automaton.iter(text):
            j = end + 1
            if ids[j] >= 0:
                continue
            i = j - length
            if i:
                apart = pairs.get(ids[i] << 32 | piece)
                if apart is None:
                    apart = self._apart(ids[i], piece)
                if not apart:
                    continue
            ids[j], starts[j] = piece, i
        out = []
        while n:
            out.append(ids[n])
            n = starts[n]
        out.reverse()
        return out

    def _best(self, text: str) -> list[int]:
        """The path of a unigram model: the largest sum of scores."""
        n = len(text)
        best = [0.0] + [None] * n
        last: list = [None] * (n + 1)  # (start, id) of the last piece
        at = 0  # all ends up to here are final

        def reach(end: int) -> None:
            nonlocal at
            for j in range(at + 1, end + 1):
                if text[j - 1] not in self.single:
                    score = best[j - 1] + self.unknown_score
                    if best[j] is None or score > best[j]:
                        best[j], last[j] = score, (j - 1, -1)
            at = end

        for end, (length, value, piece) in self.automaton.iter(text):
            if at < end:
                reach(end)
            j = end + 1
            score = best[j - length] + value
            held = best[j]
            if held is None or score > held or (score == held and j - length < last[j][0]):
                best[j], last[j] = score, (j - length, piece)
        reach(n)
        out: list[int] = []
        while n:
            start, piece = last[n]
            out.extend([piece] if piece >= 0 else reversed(self._unknown(text[start:n])))
            n = start
        out.reverse()
        return out

    def segment(self, text: str) -> array:
        """Piece ids of a normalised text."""
        if not self.merging:
            return array("i", self._best(text))
        if self.single.issuperset(text):
            return array("i", self._merged(text))
        out: list[int] = []
        for known, run in groupby(text, self.single.__contains__):
            if known:
                out += self._merged("".join(run))
            else:
                for char in run:
                    out += self._unknown(char)
        return array("i", out)

    def encode(self, text: str | None) -> array:
        ids = array("i")
        if not text:
            return ids
        if self.simple and text[0] != " " and SPACE not in text:
            # A newline is no piece, so it ends a word: it goes with what follows.
            apart = text.replace("\n", " \n")
            if "  " not in apart:
                ids.frombytes(b"".join(map(self.known.__getitem__, apart.split(" "))))
                return ids
        for word in self.words.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE)):
            ids += self.segment(word)
        return ids

    def decode(self, ids) -> str:
        shown = self.shown
        if self.special.isdisjoint(ids):
            text = "".join([shown[i] for i in ids])
        else:
            out: list[str] = []
            pending = bytearray()
            for i in ids:
                if i in self.byte_of:
                    pending.append(self.byte_of[i])
                    continue
                if pending:
                    out.append(pending.decode("utf-8", "replace"))
                    pending.clear()
                if i not in self.hidden:
                    out.append(shown[i])
            out.append(pending.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if self.prefix and text.startswith(" ") else text


class _Known(dict):
    """What a function gives for short texts, kept for those seen."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, text: str):
        found = self.make(text)
        if len(text) <= REMEMBER_CHARS:
            if len(self) >= REMEMBER:
                self.clear()
            self[text] = found
        return found


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The automaton of a model file, kept by the Python worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode(df: DataFrame, text_col: str, out: str, path: str, round_trip: str | None = None) -> DataFrame:
    """``df`` plus the piece ids of ``text_col`` (ARRAY<INT>). ``round_trip`` names a
    further column: whether the ids decode to the text (checked where they are made)."""

    @arrow_udf("struct<ids: array<int>, same: boolean>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(path)
        for texts in batches:
            flat, ends, same = array("i"), [0], []
            for t in texts.to_pylist():
                ids = model.encode(t)
                flat += ids
                ends.append(len(flat))
                same.append(model.decode(ids) == (t or "") if round_trip else None)
            values = pa.array(np.frombuffer(flat, dtype=np.int32) if flat else [], pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["ids", "same"])

    both = temp_column("pieces")
    df = df.withColumn(both, pieces(F.col(text_col))).withColumn(out, F.col(both)["ids"])
    return (df.withColumn(round_trip, F.col(both)["same"]) if round_trip else df).drop(both)


def decode(df: DataFrame, ids_col: str, out: str, path: str) -> DataFrame:
    """``df`` plus the text of the piece ids in ``ids_col`` (NULL: empty text)."""

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(path)
        for rows in batches:
            ends = np.cumsum([0, *(n or 0 for n in pc.list_value_length(rows).to_pylist())])
            flat = rows.flatten().to_numpy().tolist()
            yield pa.array([model.decode(flat[i:j]) for i, j in zip(ends, ends[1:])], pa.string())

    return df.withColumn(out, text(F.col(ids_col)))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, "text", "piece_ids", path, round_trip="round_trip")
    return coded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip")
