"""Toxicity scores from the nearest labelled examples.

Terms are words and their first 4, 5 and 6 letters (stems of inflected words).
Vectors are TF-IDF over all terms of the examples: 1 + log of the count in the text, times
the inverse document frequency over all documents. With ``label_weights`` (off unless
asked for; the registered query asks for them) a term's IDF is multiplied by its log odds ratio
between the labels, shrunk by its squared standard error (lo^3 / (lo^2 + SHRINK * var)): what
few texts show counts little, and no term is cut. Odds are counted in up to
``sample_per_class`` labelled texts of each class (smallest hashes of their ids; equal texts and,
within a class, near copies once).

The examples, up to ``examples_per_class`` of each class, form a block-max inverted
index. For a batch of texts, one product of their weights with the blocks' maxima bounds
the cosine with every example of a block; blocks are scored best bound first until no bound
reaches the ``k``-th best cosine, and what comes near that is computed again in double
precision. So the ``k`` nearest are exact, ties going to the smaller
example number. Their labels vote with weight 1 / (0.3 + 1 - cosine), corrected for how
each class was sampled; leave-one-out votes of the examples themselves, made
monotone (isotonic regression, whose inner levels hold ``k`` examples at least), turn votes into calibrated scores. A text
without any vocabulary term gets the positive rate of such examples, or, if all
have terms, the score of a text that no toxic example votes for.

Sample and examples are bounded by parameters; their terms and vectors are what goes
through the driver and is broadcast. Every text is read whole.

Defined results: NULL or empty texts have no term, texts of any length are scored whole;
NULL labels or ids teach nothing; equal texts with different labels are one example with
their mean; with no example of either class the score is the positive rate (0 without labels);
repeated rows are scored each; other columns pass through and are never read, and one named
like the output is an error.
"""

from __future__ import annotations

import string
from array import array
from collections import Counter
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf

from tessera.llm.common import read_table, settle

SAMPLE_PER_CLASS = 6000
EXAMPLES_PER_CLASS = 2000
SHRINK = 10.0
NEIGHBOURS = 25
BLOCK = 32
HEAVY = 3072
TOGETHER = 8  # blocks of one product
GROWTH = 32  # of the blocks that are asked for from round to round
ERROR = 2.0**-24  # of a cosine in single precision, for each term of the text
THRESHOLD = 0.3
REMEMBER = 5000  # texts with their scores, in a task
BATCH, BATCH_BYTES, AT_ONCE = 256, 1 << 20, 32
HELD = 1024  # texts of an Arrow batch that are Python objects at a time
RESULT = [pa.field("score", pa.float64()), pa.field("ids", pa.list_(pa.int64())), *(pa.field(x, pa.list_(pa.float64())) for x in ("cosines", "labels"))]

_FOLD = bytes(
    ord(" ") if chr(i) in string.punctuation or i < 32 or i == 127 else ord(chr(i).lower()) if i < 128 else i
    for i in range(256)
)


STEMS = (4, 5, 6)
LONGEST_FIRST = STEMS[::-1]


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII punctuation and white space, ASCII letters lower-cased."""
    return text.translate(_FOLD).split() if text else []


def min_hash(text: bytes) -> int:
    """The smallest hash of the text's five-word shingles, alike in most near copies."""
    w = words_of(text)
    return min(
        (xxhash.xxh64_intdigest(b" ".join(w[i : i + 5])) for i in range(max(1, len(w) - 4))), default=0
    ) >> 1


def terms(word: bytes) -> list[bytes]:
    """A word and its stems (marked so that they differ from words)."""
    letters = word.decode("utf-8", "replace")
    return [word, *(b"~" + letters[:n].encode() for n in STEMS if len(letters) >= n)]


class _Vocabulary(dict):
    """Terms and their numbers. A word that is no term has the number of its longest stem that is one, else their count."""

    def __missing__(self, word: bytes) -> int:
        if word.isascii():  # the stems of ``terms``, without decoding where a byte is a letter
            stems = [b"~" + word[:k] for k in LONGEST_FIRST if len(word) >= k]
        else:
            stems = terms(word)[:0:-1]
        for stem in stems:
            if stem in self:
                return self[stem]
        return len(self)


class Lexicon:
    """The vocabulary's terms of words. A word's terms are those of one term, the longest that it has
    (its own, or its longest stem): each term's own and shorter stems are listed once."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        self.vocabulary = _Vocabulary(vocabulary)
        ends, flat = array("q", [0]), array("i")
        for t in vocabulary:
            if t.startswith(b"~"):
                family = [t, *(s for s in terms(t[1:])[1:] if len(s) < len(t))]
            else:
                family = terms(t)
            flat.extend([i for s in family if (i := vocabulary.get(s)) is not None])
            ends.append(len(flat))
        ends.append(len(flat))  # no term
        self.ends, self.flat = np.array(ends, dtype=np.int64), np.array(flat, dtype=np.int32)

    def __getstate__(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        return b"\n".join(self.vocabulary), self.ends, self.flat  # words hold no white space

    def __setstate__(self, state: tuple[bytes, np.ndarray, np.ndarray]) -> None:
        names, self.ends, self.flat = state
        self.vocabulary = _Vocabulary(zip(names.split(b"\n") if names else (), range(len(self.ends))))

    def _found(self, words: list[int], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(text * terms + term) of each word's terms, and how many terms each word has."""
        at = np.array(words, dtype=np.int64)
        found, size = _runs(self.ends[at], self.ends[at + 1])
        key = np.repeat(np.repeat(np.arange(len(sizes)) * len(self.vocabulary), sizes), size)
        key += self.flat[found]
        return key, size

    def present(self, texts: list[bytes | None]) -> np.ndarray:
        """The terms of each text, once for each text that has them."""
        number = self.vocabulary.__getitem__
        words, sizes = [], []
        for t in texts:
            w = set(map(number, set(words_of(t))))
            words += w
            sizes.append(len(w))
        key = np.sort(self._found(words, sizes)[0])
        return key[np.r_[True, key[1:] != key[:-1]]] % max(1, len(self.vocabulary)) if len(key) else key

    def counts(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of all texts, ascending."""
        number = self.vocabulary.__getitem__
        words, times, sizes = [], [], []
        for t in texts:
            c = Counter(words_of(t))
            words += map(number, c)
            times += c.values()
            sizes.append(len(c))
        key, size = self._found(words, sizes)
        order = np.argsort(key)
        key, n = key[order], np.repeat(np.array(times, dtype=np.float64), size)[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        key = key[first]
        width = max(1, len(self.vocabulary))
        return key // width, key % width, np.add.reduceat(n, first) if len(first) else n


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the size of each."""
    size = last - first
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(first - (ends - size), size)
    return at, size


def _slices(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Runs of at most ``BATCH`` texts with ``BATCH_BYTES`` together, or a single text."""
    out, held = [], 0
    for t in texts:
        size = len(t or b"")
        if out and (len(out) == BATCH or held + size > BATCH_BYTES):
            yield out
            out, held = [], 0
        out.append(t)
        held += size
    if out:
        yield out


@dataclass
class Index:
    """Block-max inverted index of the examples, numbered so that like ones share blocks.

    The search reads the examples' vectors as posting lists. Those of the ``HEAVY`` terms with the
    most examples are the columns of a matrix besides. For each heavy term and block of ``BLOCK``
    examples the largest weight is kept.
    """

    lexicon: Lexicon
    idf: np.ndarray  # of each term (times its telling weight, if asked for)
    ids: np.ndarray  # document id of each example
    labels: np.ndarray
    weights: np.ndarray  # vote weight that undoes the sampling
    vector_offsets: np.ndarray  # [example]: where the example's vector starts
    vector_terms: np.ndarray
    vector_values: np.ndarray
    cuts: np.ndarray  # calibration: votes ...
    rates: np.ndarray  # ... and the rates there
    empty_rate: float

    def __getstate__(self) -> dict:
        # Postings go along where they stand for the vectors.
        kept = {*self.__dataclass_fields__} if len(self.vector_terms) else {*self.__dataclass_fields__, "_postings"}
        return {k: v for k, v in self.__dict__.items() if k in kept}

    @cached_property
    def _postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """[term]: where its postings start; postings: example, ascending, and weight."""
        by_term = np.argsort(self.vector_terms, kind="stable").astype(np.int32 if len(self.vector_terms) < 1 << 31 else np.int64)
        number = np.arange(len(self.ids), dtype=np.uint16 if len(self.ids) <= 1 << 16 else np.int32)
        example = np.repeat(number, np.diff(self.vector_offsets))[by_term]
        starts = np.r_[0, np.cumsum(np.bincount(self.vector_terms, minlength=len(self.idf)))]
        return starts, example, self.vector_values[by_term]

    @cached_property
    def _heavy(self) -> tuple[np.ndarray, np.ndarray]:
        """[term]: its column among the heavy ones, or -1; the heavy weights as a matrix, a row for each example."""
        starts, example, value = self._postings
        heavy = np.sort(np.argsort(-np.diff(starts), kind="stable")[:HEAVY])
        column = np.full(len(self.idf), -1, dtype=np.int32)
        column[heavy] = np.arange(len(heavy))
        matrix = np.zeros((self.blocks * BLOCK, len(heavy)), dtype=np.float32)
        for place, t in enumerate(heavy):
            own = slice(starts[t], starts[t + 1])
            matrix[example[own], place] = value[own]
        return column, matrix

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)

    @cached_property
    def most(self) -> np.ndarray:
        """[heavy term, block]: the largest weight among the block's postings."""
        matrix = self._heavy[1]
        return np.ascontiguousarray(matrix.reshape(self.blocks, BLOCK, matrix.shape[1]).max(axis=1).T)

    def search_only(self) -> None:
        """Keep the examples' vectors as postings only."""
        if len(self.vector_terms):
            self._postings
            self.vector_offsets = np.zeros_like(self.vector_offsets)
            self.vector_terms, self.vector_values = self.vector_terms[:0].copy(), self.vector_values[:0].copy()

    def rest(self) -> None:
        """Let go what the next search builds again from the postings."""
        self.__dict__.pop("_heavy", None)
        self.__dict__.pop("most", None)

    def own_vectors(self, examples: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place among ``examples``, term, weight), ascending: their vectors, from the postings."""
        starts, example, value = self._postings
        place = np.full(len(self.ids), -1, dtype=np.int32)
        place[examples] = np.arange(len(examples))
        at = np.flatnonzero((place >= 0)[example])
        at = at[np.argsort(place[example[at]], kind="stable")]
        return place[example[at]].astype(np.int64), np.searchsorted(starts, at, side="right") - 1, value[at].astype(np.float64)

    def vectors(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, weight) of the texts' vectors, each of length 1; none for a text without a term."""
        text, term, n = self.lexicon.counts(texts)
        w = (1 + np.log(n)) * self.idf[term]
        size = np.sqrt(np.bincount(text, w * w, len(texts)))
        keep = size[text] > 0
        return text[keep], term[keep], w[keep] / size[text[keep]]

    def nearest(
        self, vectors: tuple[np.ndarray, np.ndarray, np.ndarray], m: int, k: int, but: np.ndarray | None = None
    ) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """For each of ``m`` texts the cosines and numbers of its k nearest examples with a cosine above 0
        (without example ``but``), best first; and how many blocks were scored.

        The light terms' parts of all cosines are added up from their lists. What the
        heavy terms can add to a block is at most their weights times the block's maxima: one
        product gives all bounds. Blocks are scored best bound first, in rounds, as long as
        their bound reaches the k-th best cosine found. Bounds and heavy terms' parts are in single
        precision; examples within its error of the k-th best get theirs again in double precision.
        """
        text, term, w = vectors
        starts, example, value = self._postings
        column, matrix = self._heavy
        width = self.blocks * BLOCK
        at = column[term]
        heavy, light = at >= 0, np.flatnonzero(at < 0)
        h_column, h_weight, h_first = at[heavy], w[heavy], np.searchsorted(text[heavy], np.arange(m + 1))
        query = np.zeros((m, matrix.shape[1]), dtype=np.float32)
        query[text[heavy], h_column] = h_weight
        # What two sums of a text's terms can be off together.
        error = 2 * ERROR * (np.bincount(text, minlength=m) + 8)
        # A few texts at a time: their light postings are many.
        part = np.empty((m, width))
        l_text, l_term, l_weight = text[light], term[light], w[light]
        l_first = np.searchsorted(l_text, np.arange(m + 1))
        for lo in range(0, m, AT_ONCE):
            hi = min(lo + AT_ONCE, m)
            some = slice(l_first[lo], l_first[hi])
            found, size = _runs(starts[l_term[some]], starts[l_term[some] + 1])
            at = np.repeat((l_text[some] - lo) * width, size)
            at += example[found]
            sums = np.bincount(at, np.repeat(l_weight[some], size) * value[found], (hi - lo) * width)
            part[lo:hi] = sums.reshape(hi - lo, width)
        bound = query @ self.most + part.reshape(m, self.blocks, BLOCK).max(axis=2)
        order = np.argsort(-bound, axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(self.blocks)[None, :], axis=1)
        scores = np.zeros((m, width), dtype=np.float32)
        kth = np.zeros(m, dtype=np.float32)
        done, upto, scored = 0, -(-4 * k // BLOCK), 0
        while done < self.blocks:
            asked = (rank >= done) & (rank < upto) & (bound > 0) & (bound >= (kth - error)[:, None])
            if not asked.any():
                break  # bounds fall along the ranks, and the k-th best only rises
            many = asked.sum(axis=0)
            for b in np.flatnonzero((many > 0) & (many < m // 4)):
                rows = np.flatnonzero(asked[:, b])
                at = slice(b * BLOCK, (b + 1) * BLOCK)
                scores[rows, at] = part[rows, at] + query[rows] @ matrix[at].T
            # Blocks that many texts ask for: some of them at once, for all texts.
            wide = np.flatnonzero(many >= max(1, m // 4))
            for i in range(0, len(wide), TOGETHER):
                some = wide[i : i + TOGETHER]
                at = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                sums = part[:, at] + query @ matrix[at].T
                scores[:, at] = np.where(np.repeat(asked[:, some], BLOCK, axis=1), sums, scores[:, at])
            scored += int(many.sum())
            if but is not None:
                scores[np.arange(m), but] = 0
            kth = np.partition(scores, width - k, axis=1)[:, width - k] if width > k else kth
            done, upto = upto, GROWTH * upto
        out = []
        for t in range(m):
            near = np.flatnonzero(scores[t] > max(kth[t] - error[t], 0))
            mine = slice(h_first[t], h_first[t + 1])
            exact = np.round(part[t, near] + matrix[near[:, None], h_column[mine]] @ h_weight[mine], 12)
            best = np.lexsort((near, -exact))[:k]
            best = best[exact[best] > 0]
            out.append((exact[best], near[best]))
        return out, scored

    def vote(self, cosines: np.ndarray, found: np.ndarray) -> float:
        v = self.weights[found] / (1.3 - cosines)
        return float((v * self.labels[found]).sum() / v.sum())

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, self.cuts, self.rates)) if len(self.cuts) else self.empty_rate


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression: the points of a line that is level where the
    fit is and straight between its levels. A level between others with fewer than ``least``
    points tells little of its own: it joins the neighbour with the nearer rate."""
    levels: list[list[float]] = []  # first x, last x, sum of w * y, sum of w, points
    for i in np.argsort(x, kind="stable"):
        if levels and levels[-1][1] == x[i]:
            levels[-1][2] += w[i] * y[i]
            levels[-1][3] += w[i]
            levels[-1][4] += 1
        else:
            levels.append([x[i], x[i], w[i] * y[i], w[i], 1])
        while len(levels) > 1 and levels[-2][2] * levels[-1][3] >= levels[-1][2] * levels[-2][3]:
            _merge(levels, len(levels) - 2)
    while True:
        small = [i for i in range(1, len(levels) - 1) if levels[i][4] < least]
        if not small:
            break
        i = min(small, key=lambda i: levels[i][4])
        rate = [levels[j][2] / levels[j][3] for j in (i - 1, i, i + 1)]
        _merge(levels, i - 1 if rate[1] - rate[0] <= rate[2] - rate[1] else i)
    return np.array([e for v in levels for e in v[:2]]), np.repeat([v[2] / v[3] for v in levels], 2)


def _merge(levels: list[list[float]], i: int) -> None:
    """Level ``i`` takes in the next one."""
    _, last, p, n, points = levels.pop(i + 1)
    levels[i][1] = last
    levels[i][2] += p
    levels[i][3] += n
    levels[i][4] += points


def training_rows(id_col: str) -> F.Column:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def _sample(labels: DataFrame, id_col: str, label_col: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    rows = labels.where(training_rows(id_col) & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")
    )
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [
        rows.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)
    ]
    return settle(picked[0].unionByName(picked[1])), totals


def _vocabulary(
    texts: DataFrame, examples: set[int], max_terms: int | None, min_chi2: float, min_odds: float
) -> tuple[list[bytes], np.ndarray]:
    """The terms of the ``examples`` and their weights, counted in ``texts``: (id, y, t)."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), BATCH):
                some = frame.iloc[start : start + BATCH]
                found = [list({x for w in set(words_of(bytes(t))) for x in terms(w)}) for t in some["t"]]
                size = [len(f) for f in found]
                own = np.array([i in examples for i in some["id"]], dtype=bool)
                yield pd.DataFrame({
                    "term": [x for f in found for x in f], "y": np.repeat(some["y"].to_numpy(dtype=np.float64), size), "e": np.repeat(own, size),
                })

    n, p = texts.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not p or p == n:
        return [], np.zeros(0)
    a, df = F.col("a"), F.col("df")
    b, c = df - a, F.lit(float(p)) - a
    d = F.lit(float(n - p)) - b
    odds = (a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5))
    chi2 = F.lit(float(n)) * F.pow(a * d - b * c, F.lit(2)) / (df * (F.lit(float(n)) - df) * F.lit(float(p)) * F.lit(float(n - p)))
    counted = texts.mapInPandas(each, "term binary, y double, e boolean").groupBy("term").agg(
        F.sum("y").alias("a"), F.count(F.lit(1)).cast("double").alias("df"), F.max("e").alias("e")
    ).where("e")
    if max_terms is not None or min_chi2 > 0 or min_odds > 1:  # a caller's smaller vocabulary
        counted = counted.withColumn("chi2", F.round(chi2, 9)).where(F.col("chi2") >= min_chi2).where((odds >= min_odds) | (odds <= 1 / min_odds))
        counted = counted if max_terms is None else counted.orderBy(F.desc("chi2"), "term").limit(max_terms)
    got = counted.select("term", "a", "df").toArrow()
    names = got["term"].to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    a, df = (got[x].to_numpy()[order] for x in ("a", "df"))
    b, c = df - a, p - a
    d = n - p - b
    lo = np.log((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5)))
    var = 1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (c + 0.5) + 1 / (d + 0.5)
    return [names[i] for i in order], np.abs(lo) * lo**2 / (lo**2 + SHRINK * var)


def _document_frequencies(docs: DataFrame, text_col: str, lexicon: Lexicon) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = shared.value
        n, df = 0, np.zeros(len(lexicon.vocabulary), dtype=np.int64)
        for frame in frames:
            n += len(frame)
            for texts in _slices(list(frame["t"])):
                df += np.bincount(lexicon.present(texts), minlength=len(df))
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.r_[-1, at], "n": np.r_[n, df[at]]})

    total = np.zeros(len(lexicon.vocabulary), dtype=np.int64)
    rows = docs.select(F.col(text_col).cast("binary").alias("t")).mapInPandas(count, "term long, n long")
    got = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = got["term"].to_numpy(), got["n"].to_numpy()
    total[at[at >= 0]] = n[at >= 0]
    shared.unpersist()
    return int(n[at < 0].sum()), total


def _distinct(frame: pd.DataFrame) -> pd.DataFrame:
    """Of labelled texts with one min-hash (id, y, t): equal texts are one with their mean label,
    and near copies (five-word shingles, Jaccard 0.8 or more) of equal label are one. The smallest id stays."""
    equal: dict[bytes, list[tuple[int, float]]] = {}
    for i, y, t in sorted(zip(frame["id"], frame["y"], map(bytes, frame["t"]))):
        equal.setdefault(t, []).append((i, y))
    kept: list[tuple[float, set]] = []
    rows = []
    for t, same in equal.items():
        y = sum(y for _, y in same) / len(same)
        if len(equal) > 1:
            w = words_of(t)
            own = {b" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
            if any(
                y == other and 0.8 * max(len(own), len(there)) <= min(len(own), len(there)) and 1.8 * len(own & there) >= 0.8 * (len(own) + len(there))
                for other, there in kept
            ):
                continue
            kept.append((y, own))
        rows.append((same[0][0], y, t))
    return pd.DataFrame(rows, columns=["id", "y", "t"])


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_per_class: int = SAMPLE_PER_CLASS, examples_per_class: int = EXAMPLES_PER_CLASS, max_terms: int | None = None,
    min_chi2: float = 0.0, min_odds: float = 1.0, k: int = NEIGHBOURS, label_weights: bool = False,
) -> Index:
    """Fit the index on training rows of ``labels`` (see ``training_rows``). All terms of
    the examples count unless ``max_terms``, ``min_chi2`` or ``min_odds`` are given. The
    cosine is that of plain TF-IDF; ``label_weights`` multiplies each term's IDF by how much
    it tells the labels apart."""
    sample, totals = _sample(labels, id_col, label_col, sample_per_class)
    rate = totals.get(1, 0) / max(1, sum(totals.values()))
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t")).join(
        F.broadcast(sample.groupBy("id").agg(F.avg("y").alias("y"))), "id"
    )

    @pandas_udf("long")
    def alike(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([min_hash(bytes(t)) for t in texts])

    texts = settle(chosen.groupBy(alike("t").alias("h")).applyInPandas(_distinct, "id long, y double, t binary"))
    order = [F.xxhash64("id"), F.col("id")]
    classes = [(F.col("y") > 0.5), (F.col("y") <= 0.5)]
    picked = [texts.where(c).orderBy(*order).limit(examples_per_class).select("id") for c in classes]
    chosen_ids = [{r["id"] for r in p.collect()} for p in picked]
    names, telling = _vocabulary(texts, chosen_ids[0] | chosen_ids[1], max_terms, min_chi2, min_odds)
    lexicon = Lexicon({t: i for i, t in enumerate(names)})
    n, df = _document_frequencies(docs, text_col, lexicon) if names else (0, np.zeros(0))
    idf = (np.log((1 + n) / (1 + df)) + 1) * (telling if label_weights else 1.0)
    index = Index(lexicon, idf, *[np.zeros(0)] * 3, np.zeros(1, dtype=np.int64), *[np.zeros(0)] * 4, rate)
    ids = chosen_ids[0] | chosen_ids[1]

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[[i in ids for i in frame["id"]]]
            at, w = [], []
            for texts in _slices([bytes(t) for t in frame["t"]]):
                text, term, weight = index.vectors(texts)
                ends = np.searchsorted(text, np.arange(1, len(texts)))
                at += [p.astype(np.int32).tobytes() for p in np.split(term, ends)]
                w += [p.astype(np.float32).tobytes() for p in np.split(weight, ends)]
            yield pd.DataFrame({"id": frame["id"].to_numpy(), "y": frame["y"].to_numpy(), "at": at, "w": w})

    # What one example of each class stands for among the labelled rows.
    stands = [totals.get(y, 0) / max(1, len(chosen_ids[1 - y])) for y in (0, 1)]
    rows = [
        (r["id"], r["y"], np.frombuffer(r["at"], dtype=np.int32), np.frombuffer(r["w"], dtype=np.float32), stands[int(r["y"] > 0.5)])
        for r in texts.select("id", "y", "t").mapInPandas(vectors, "id long, y double, at binary, w binary").collect()
    ]
    if not rows:
        return index
    # Like examples near each other: by their heaviest term, then the next ones.
    rows.sort(key=lambda r: (r[2][np.argsort(-r[3], kind="stable")[:4]].tolist(), r[0]))
    index.ids = np.array([r[0] for r in rows], dtype=np.int64)
    index.labels = np.array([r[1] for r in rows])
    index.weights = np.array([r[4] for r in rows])
    sizes = np.array([len(r[2]) for r in rows])
    index.vector_offsets = np.r_[0, np.cumsum(sizes)]
    index.vector_terms = np.concatenate([r[2] for r in rows])
    index.vector_values = np.concatenate([r[3] for r in rows])
    del rows
    # Each example's vote by the others, where the examples are searched anyway: on the executors.
    spark = docs.sparkSession
    bare = copy(index)
    bare.search_only()
    shared = spark.sparkContext.broadcast(bare)

    def left_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for frame in frames:
            some = frame["id"].to_numpy()
            own = index.own_vectors(some)
            near = index.nearest(own, len(some), k, but=some)[0] if len(own[0]) else []
            told = [(e, index.vote(c, f)) for e, (c, f) in zip(some, near) if len(f)]
            yield pd.DataFrame(told, columns=["e", "vote"]).astype({"e": "int64", "vote": "float64"})

    parts = -(-len(sizes) // BATCH)
    got = spark.range(0, len(sizes), 1, parts).mapInPandas(left_out, "e long, vote double").toArrow()
    shared.unpersist()
    told, votes = got["e"].to_numpy(), got["vote"].to_numpy()
    votes, told = votes[np.argsort(told)], np.sort(told)
    none = sizes == 0
    if none.any():
        index.empty_rate = float((index.labels * index.weights)[none].sum() / index.weights[none].sum())
    if len(told):
        index.cuts, index.rates = isotonic(votes, index.labels[told], index.weights[told], k)
        if not none.any():
            index.empty_rate = index.calibrated(0.0)  # no example votes for it
    return index


def score(
    docs: DataFrame, index: Index, out: str = "toxicity", text_col: str = "text", k: int = NEIGHBOURS, evidence: int = 3
) -> DataFrame:
    """``docs`` plus the struct ``out``: ``score`` (0 to 1) and, best first, the
    ``ids``, ``cosines`` and ``labels`` of the nearest ``evidence`` examples."""
    bare = copy(index)
    bare.search_only()
    shared = docs.sparkSession.sparkContext.broadcast(bare)

    @arrow_udf("score double, ids array<long>, cosines array<double>, labels array<double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        nothing = (index.empty_rate, [], [], [])

        def rows_of(texts: list[bytes]) -> list[tuple]:
            rows = []
            for cosines, found in index.nearest(index.vectors(texts), len(texts), k)[0]:
                if len(found):
                    top = found[:evidence]
                    row = (index.calibrated(index.vote(cosines, found)), index.ids[top].tolist(), cosines[:evidence].tolist(), index.labels[top].tolist())
                else:
                    row = nothing
                rows.append(row)
            return rows

        known: dict = {}
        for batch in batches:
            rows = []
            for start in range(0, len(batch), HELD):  # some of the batch as Python objects at a time
                texts = batch.slice(start, HELD).to_pylist()
                keys = [None if t is None else xxhash.xxh3_128_digest(t) for t in texts]
                if len(known) >= REMEMBER:
                    known.clear()
                new = {key: t for key, t in zip(keys, texts) if key is not None and key not in known}
                for some in _slices(list(new.values())) if len(index.ids) else ():
                    known.update(zip((xxhash.xxh3_128_digest(t) for t in some), rows_of(some)))
                rows += [known.get(key, nothing) for key in keys]
            columns = zip(RESULT, zip(*rows) if rows else [()] * len(RESULT))
            yield pa.StructArray.from_arrays([pa.array(list(v), f.type) for f, v in columns], fields=RESULT)
        index.rest()  # the worker and its broadcasts outlive the task

    if out in docs.columns:
        raise ValueError(f"column {out!r} is there already")
    return docs.withColumn(out, scored(F.col(text_col).cast("binary")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document from the labels of the training rows."""
    docs = read_table(spark, sf_dir, "documents")
    index = learn(docs, read_table(spark, sf_dir, "labels"), label_weights=True)
    scored = score(docs.select("doc_id", "text"), index)
    return scored.select(
        "doc_id",
        (~training_rows("doc_id") & F.col("doc_id").isNotNull()).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("toxicity.ids").alias("evidence_ids"),
    )
