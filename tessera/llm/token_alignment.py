"""Cross-tokenizer alignment: which tokens of two vocabularies end at the same byte.

A byte-level BPE vocabulary (A) and a SentencePiece model (B) encode the same bytes.
Where tokens of both end at one byte, the text has a cut; cuts part the tokens into
groups, and the A and B tokens that end there are linked. Links are counted over
the corpus, and each document tells how its links stand in that count.

Arrow does the work in a task, Spark spreads and merges it:

* Token lists are flattened; byte lengths are looked up by token id, and a cumulative
  sum, less its value at the document's start, gives each token's end.
* Both sides lie in order of document and end, so they meet by binary search, without a
  hash table or a sort. Group texts are joined from lists cut at the shared ends.
* ``Table.group_by`` counts a batch's pairs. The alignments are stored once; a
  second Arrow pass gives partial counts of its pairs, which Spark sums up.
* Pairs with at least a ``1 / HEAD`` share of all links are at most ``HEAD`` by
  arithmetic. They are broadcast, and the links of all documents meet them without
  a shuffle; what is left is rarer than that, hence not skewed, and is shuffled by
  pair. The most frequent partner of a B token is a table of at most as many rows
  as the vocabulary has.

A batch is worked off in slices of ``SLICE_BYTES`` of text; a longer document is a
slice of its own.

Defined results. A text that is NULL, empty, or whose joined A or B bytes differ from
space + text (a literal U+2581 that B writes as a space, say) has no tokens: all
counts 0, ``groups_sha256`` ''. Strings of special tokens inside a text are plain
text. Repeated rows are aligned and counted each; ties for the most frequent partner
all count as best. Texts of any length are aligned whole. An empty table gives no
rows. The input's columns are read by the names given; ``keep`` passes columns through
(a name that the result has itself is an error) and others are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import quoted, read_table, stored
from tessera.llm.token_counts import _byte_of

SLICE_BYTES = 1 << 20
HEAD = 1 << 16
# Distinct pairs that a task collects before it hands them on.
MAX_PAIRS = 1 << 20

PER_DOC = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
TOTALS = ("n_best", "count_sum")
ALIGNED = (
    "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a array<int>, b array<int>, times array<int>"
)


class Vocabularies:
    """Both tokenizers with the bytes, byte lengths and decimal texts of their ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_of()
        with open(path_a, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        bytes_a = [b""] * max(self.a.get_vocab_size(), max(vocab.values()) + 1)
        for token, i in vocab.items():
            bytes_a[i] = bytes(byte_of[c] for c in token)
        bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in known], np.int64) for known in (bytes_a, bytes_b))
        self.shown = pa.array([str(i) for i in range(max(len(bytes_a), len(bytes_b)))])

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return pa.array(a, pa.list_(pa.int32())), pa.array(self.b.encode(texts, num_threads=1), pa.list_(pa.int32()))


_loaded: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """The two tokenizers, kept by the Python worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Vocabularies(path_a, path_b)
    return _loaded[path_a, path_b]


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def _side(lists: pa.ListArray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of one vocabulary: document, byte at which each ends (a segmented cumulative sum) and id."""
    sizes = pc.list_value_length(lists).to_numpy()
    ids = lists.flatten().to_numpy()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    total = np.concatenate([[0], np.cumsum(lengths[ids])])
    before = total[np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)] if len(sizes) else total
    return doc, total[1:] - before[doc], ids


def _meeting(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all A and B tokens of a document that end together, by A place, then B place. Both sides
    lie in order of document and end, so those of an A token are a run of B tokens."""
    span = int(max((e.max(initial=0) for _, e, _ in (a, b)))) + 1
    of_a, of_b = (doc * span + end for doc, end, _ in (a, b))
    first = np.searchsorted(of_b, of_a, "left")
    times = np.searchsorted(of_b, of_a, "right") - first
    a_at = np.repeat(np.arange(len(of_a)), times)
    return a_at, np.arange(len(a_at)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)


def _joined(lists: pa.ListArray, table: pa.Array, separator) -> pa.Array:
    """Each list's entries looked up in ``table`` and joined."""
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, pc.take(table, lists.values)), separator)


def _cut(ids: np.ndarray, last: np.ndarray, shown: pa.Array) -> pa.Array:
    """The ids of each group as text; ``last``: the place of every group's last token."""
    offsets = pa.array(np.concatenate([[0], last + 1]), pa.int32())
    return _joined(pa.ListArray.from_arrays(offsets, pa.array(ids)), shown, ",")


def align_slice(texts: list[str | None], v: Vocabularies) -> pa.Table:
    """The alignment of some texts: a row each, in their order (columns of ``ALIGNED`` without ``row``)."""
    n = len(texts)
    texts = [t or "" for t in texts]
    a, b = v.encode(texts)
    want = pa.array([b" " + t.encode() for t in texts], pa.binary())
    same = pc.and_(pc.equal(_joined(a, v.bytes_a, b""), want), pc.equal(_joined(b, v.bytes_b, b""), want))
    same = pc.and_(same, pc.not_equal(pa.array(texts), ""))
    if not pc.all(same).as_py():
        none = pa.scalar([], a.type)
        a, b = pc.if_else(same, a, none), pc.if_else(same, b, none)
    side_a, side_b = _side(a, v.lengths_a), _side(b, v.lengths_b)
    a_at, b_at = _meeting(side_a, side_b)
    doc, end, ids_a = (c[a_at] for c in side_a)
    # The last link of each shared end closes a group (documents end in one).
    closes = np.ones(len(doc), dtype=bool)
    closes[:-1] = (doc[1:] != doc[:-1]) | (end[1:] != end[:-1])
    groups = pc.binary_join_element_wise(
        _cut(side_a[2], a_at[closes], v.shown), _cut(side_b[2], b_at[closes], v.shown), "|",
    )
    count = lambda d: np.bincount(d, minlength=n).astype(np.int64)
    n_groups = count(doc[closes])
    written = pc.binary_join(pa.ListArray.from_arrays(_offsets(n_groups), groups), ";")
    links = pa.table({"doc": doc, "a": ids_a, "b": side_b[2][b_at]})
    pairs = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
    at = _offsets(count(pairs["doc"].to_numpy()))
    part = lambda c: pa.ListArray.from_arrays(at, pairs[c].combine_chunks().cast(pa.int32()))
    return pa.table({
        "n_a": count(side_a[0]), "n_b": count(side_b[0]), "n_groups": n_groups, "n_links": count(doc),
        "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if k else "" for t, k in zip(written.to_pylist(), n_groups)],
        "a": part("a"), "b": part("b"), "times": part("count_all"),
    })


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most ``most`` bytes together, or a single text."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def alignments(docs: DataFrame, text: str, path_a: str, path_b: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every row's alignment, with its distinct links (``a``, ``b``, ``times``) and a row number
    of its own. To be stored before it is read twice: the numbers are given by tasks."""
    kept = [f"keep_{i}" for i in range(len(keep))]
    (t,) = quoted([text])
    source = docs.select(t.alias("text"), *[c.alias(k) for c, k in zip(quoted(list(keep)), kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(path_a, path_b)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            for start, end in _slices(sizes, SLICE_BYTES):
                piece = batch.slice(start, end - start)
                out = align_slice(piece["text"].to_pylist(), v)
                out = out.add_column(0, "row", pa.array(np.arange(row, row + end - start)))
                for k in kept:
                    out = out.append_column(k, piece[k])
                row += end - start
                yield from out.combine_chunks().to_batches()

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    return source.mapInArrow(run, ALIGNED + extra)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's pairs by ``Table.group_by``, handed on whenever many are held."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        counted = pa.concat_tables(parts).group_by(["a", "b"], use_threads=False).aggregate([("links", "sum")])
        return counted.rename_columns({"links_sum": "links"}).select(["a", "b", "links"])

    parts, held = [], 0
    for batch in batches:
        columns = {c: batch[c].flatten() for c in ("a", "b", "times")}
        columns["links"] = columns.pop("times").cast(pa.int64())
        parts.append(merged([pa.table(columns)]))
        held += len(parts[-1])
        if held > MAX_PAIRS:
            parts = [merged(parts)]
            held = len(parts[0])
            if held > MAX_PAIRS // 2:
                yield from parts[0].combine_chunks().to_batches()
                parts, held = [], 0
    if parts:
        yield from merged(parts).combine_chunks().to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, links, best): how many links hold the pair, and whether no partner of ``b`` has more."""
    parts = aligned.select("a", "b", "times").mapInArrow(_partial, "a int, b int, links long")
    counts = stored(parts.groupBy("a", "b").agg(F.sum("links").alias("links")))
    top = counts.groupBy("b").agg(F.max("links").alias("most"))  # a row per B token at most
    return counts.join(F.broadcast(top), "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, text: str, path_a: str, path_b: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs): every row's counts ``PER_DOC`` and ``TOTALS`` beside the columns ``keep``, and
    the corpus-wide pair counts."""
    clash = {c.lower() for c in keep} & {*PER_DOC, *TOTALS}
    if clash:
        raise ValueError(f"columns named like the result's: {sorted(clash)}")
    aligned = stored(alignments(docs, text, path_a, path_b, keep))
    pairs = stored(pair_counts(aligned))
    head = F.col("links") * HEAD >= pairs.agg(F.sum("links")).scalar()
    each = aligned.select("row", F.inline(F.arrays_zip("a", "b", "times")))
    near = each.join(F.broadcast(pairs.where(head)), ["a", "b"], "left")
    far = near.where("links IS NULL").select("row", "a", "b", "times").join(pairs.where(~head).hint("merge"), ["a", "b"])
    # Summed up by row on the map side: a document's links lie together.
    sums = lambda df: df.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"),
    )
    columns = ["row", "times", "links", "best"]
    totals = sums(near.where("links IS NOT NULL").select(columns).unionByName(far.select(columns)))
    rows = aligned.drop("a", "b", "times").join(totals, "row", "left")
    names = [F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)]
    return rows.select(*names, *PER_DOC, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in TOTALS]), pairs


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment between the byte-level BPE and the piece vocabulary."""
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path
    return align(docs, "text", path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), ["doc_id"])[0]
