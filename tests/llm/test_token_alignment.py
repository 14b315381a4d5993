"""Alignments equal a plain walk over both token lists; totals equal counts over all documents."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tessera.llm import token_alignment
from tessera.llm.common import read_table, ship
from tests.conftest import SF_SMALL
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = ["the", " ", "\n", "\t", "a▁b", "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "é", "日本", "😀", "\x00", "x" * 90, "1234", "  ", "▁", "ß", "don't"]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, decoders.ByteLevel(), sentencepiece.SentencePieceProcessor(model_file=B)


def spans(tokens):
    at, out = 0, []
    for i, b in tokens:
        at += len(b)
        out.append((i, at))
    return out


def walk(text, tokenizers):
    """(n_a, n_b, groups, links) of one text, token by token."""
    a, _, b = tokenizers
    if not text:
        return 0, 0, [], []
    unshown = token_alignment._byte_of()
    side_a = [(i, bytes(unshown[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        side_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in side_a) != whole or b"".join(x for _, x in side_b) != whole:
        return 0, 0, [], []
    ends_a, ends_b = spans(side_a), spans(side_b)
    shared = sorted({e for _, e in ends_a} & {e for _, e in ends_b})
    groups, links, before = [], [], 0
    for cut in shared:
        in_a = [i for i, e in ends_a if before < e <= cut]
        in_b = [i for i, e in ends_b if before < e <= cut]
        groups.append(",".join(map(str, in_a)) + "|" + ",".join(map(str, in_b)))
        links += [(i, j) for i, e in ends_a if e == cut for j, f in ends_b if f == cut]
        before = cut
    return len(ends_a), len(ends_b), groups, links


def brute(texts, tokenizers):
    done = {t: walk(t, tokenizers) for t in set(texts)}
    counts = Counter(p for t in texts for p in done[t][3])
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for t in texts:
        n_a, n_b, groups, links = done[t]
        out.append((
            n_a, n_b, len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
        ))
    return out, counts


def texts_of_all_kinds():
    rng = random.Random(4)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 25))) for _ in range(120)]


def same(df, texts_by_id, tokenizers):
    want, _ = brute(list(texts_by_id.values()), tokenizers)
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    assert got == dict(zip(texts_by_id, want))


@pytest.mark.parametrize("head", [1, 20, 1 << 16])
def test_equals_a_plain_walk_wherever_the_head_ends(spark, tokenizers, monkeypatch, head):
    ship(spark)
    monkeypatch.setattr(token_alignment, "HEAD", head)
    texts = texts_of_all_kinds() + ["a word and a word"] * 40
    df = docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(3)
    same(token_alignment.align(df, "text", A, B, ["doc_id"])[0], dict(enumerate(texts)), tokenizers)


def test_query_equals_a_plain_walk(spark, tokenizers):
    ship(spark)
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").where("length(text) < 6000").collect()
    texts = {r[0]: r[1] for r in rows}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    same(token_alignment.align(df, "text", A, B, ["doc_id"])[0], texts, tokenizers)
    assert token_alignment.op11_token_alignment(spark, SF_SMALL).count() == read_table(spark, SF_SMALL, "documents").count()


def test_pair_counts(spark, tokenizers):
    ship(spark)
    texts = texts_of_all_kinds()
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    _, counts = brute(texts, tokenizers)
    assert {(r["a"], r["b"]): r["links"] for r in token_alignment.align(df, "text", A, B)[1].collect()} == counts


def test_slices_do_not_matter(tokenizers):
    v = token_alignment.vocabularies(A, B)
    texts = texts_of_all_kinds()
    whole = token_alignment.align_slice(texts, v).select(["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]).to_pylist()
    parts = [r for s, e in token_alignment._slices([len(t) for t in texts], 50) for r in token_alignment.align_slice(texts[s:e], v)
             .select(["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]).to_pylist()]
    assert whole == parts


def test_edge_rows(spark, tokenizers):
    ship(spark)
    df = docs_frame(spark, EDGE_ROWS)
    got = token_alignment.align(df, "text", A, B, ["doc_id", "label"])[0].collect()
    short = [(i, t) for i, t, _ in EDGE_ROWS if t is None or len(t) < 5000]
    done = {(i, t): walk(t, tokenizers) for i, t in short}
    assert sorted((str(r["doc_id"]), r["n_a"], r["n_b"], r["n_links"]) for r in got if r["n_a"] < 5000) == sorted(
        (str(i), d[0], d[1], len(d[3])) for i, t in short for d in [done[i, t]]
    )
    assert len(got) == len(EDGE_ROWS) and max(r["n_a"] for r in got) >= 20_000
    assert token_alignment.align(spark.createDataFrame([], DOCS), "text", A, B, ["doc_id"])[0].count() == 0


def test_names_of_the_result_are_refused(spark):
    df = spark.createDataFrame([("a", 1)], "text string, n_a long")
    with pytest.raises(ValueError, match="n_a"):
        token_alignment.align(df, "text", A, B, ["n_a"])


def test_sides_meet_by_search():
    """All A and B tokens of a document that end together, empty tokens and documents without tokens included."""
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 2, 3])
    lists = [pa.array([rng.integers(0, 4, n).tolist() for n in sizes], pa.list_(pa.int32())) for sizes in ([5, 0, 7, 1, 0], [6, 2, 4, 0, 0])]
    a, b = (token_alignment._side(side, lengths) for side in lists)
    ends = lambda side: [(d, e) for d, ids in enumerate(side.to_pylist()) for e in np.cumsum(lengths[ids] if ids else [])]
    assert [[*zip(s[0].tolist(), s[1].tolist())] for s in (a, b)] == [ends(side) for side in lists]
    want = [(i, j) for i, x in enumerate(ends(lists[0])) for j, y in enumerate(ends(lists[1])) if x == y]
    assert [*zip(*(at.tolist() for at in token_alignment._meeting(a, b)))] == want and want
    none = token_alignment._side(pa.array([[], []], pa.list_(pa.int32())), lengths)
    assert [len(at) for at in token_alignment._meeting(none, none)] == [0, 0]
