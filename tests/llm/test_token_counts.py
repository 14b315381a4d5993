"""Counts equal the tokenizers library's."""

import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import token_counts
from tessera.llm.common import read_table, ship
from tests.conftest import SF_SMALL
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "'", "'s", "'re", "'ll", "ve", " ", "  ", "\n", "\t", "a", "B", "é", "日本", "1", "23", "!", "...", "<|endoftext|>", " ", "ing",
    "the", "x" * 300, "don't", "😀", "\x00", "ß", "l", "r", "e", "\r\n", "​", "-",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counted(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def fuzz(n=1500, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 60))) for _ in range(n)]


def test_equals_library_on_mixed_text(library):
    texts = [*fuzz(), "", "a" * 5000, " " * 3000, "'" * 700, "abcdefghij" * 900]
    assert token_counts.Transducer(PATH).counts(texts).tolist() == counted(library, texts)


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_cuts_do_not_matter(library, chunk, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    texts = fuzz(200, seed=2)
    assert token_counts.Transducer(PATH).counts(texts).tolist() == counted(library, texts)


def test_restarts_do_not_matter(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 500)
    monkeypatch.setattr(token_counts, "MAX_PAIRS", 100)
    texts = fuzz(200, seed=3)
    assert token_counts.Transducer(PATH).counts(texts).tolist() == counted(library, texts)


def long_runs(size, seed=4):
    """Pre-tokens over many chunks: letters at random, of syllables, periodic ones and other scripts."""
    rng = random.Random(seed)
    draw = lambda parts, n: "".join(rng.choices(parts, k=n))
    return [
        draw("abcdefghijklmnop", size), draw(["the", "ing", "tion", "er", "wh"], size // 3), "a" * size, "ab" * (size // 2) + "c", "abcdefg" * (size // 7),
        draw("日本語漢字中文", size // 3), draw(["x", "é", "ß", "ing"], size // 2) + " " + draw("XYZ", size // 4), " " * size + "x",
    ]


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_maps_of_chunks_without_a_start_compose(library, chunk, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    texts = long_runs(1500) + fuzz(20, seed=5)
    assert token_counts.Transducer(PATH).counts(texts).tolist() == counted(library, texts)


def test_restarts_amid_long_runs(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 300)
    monkeypatch.setattr(token_counts, "CHUNK", 50)
    texts = long_runs(2000, seed=6)
    assert token_counts.Transducer(PATH).counts(texts).tolist() == counted(library, texts)


def test_a_million_letters_take_seconds(library):
    from time import perf_counter

    text = "".join(random.Random(8).choices(["the", "ing", "tion", "er", "wh", "st", "en", "ou"], k=400_000))
    assert len(text) > 990_000
    machine = token_counts.Transducer(PATH)
    start = perf_counter()
    got = machine.counts([text]).tolist()
    assert perf_counter() - start < 5 and got == counted(library, [text])


def test_query_equals_library(spark, library):
    got = {r["doc_id"]: r for r in token_counts.op3_token_counts(spark, SF_SMALL).collect()}
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    for r, n in zip(rows, counted(library, [r["text"] or "" for r in rows])):
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["over_limit"]) == (n, n > 512)
        assert got[r["doc_id"]]["n_bytes"] == len((r["text"] or "").encode())


def test_edge_rows(spark, library):
    ship(spark)
    rows = token_counts.with_token_count(docs_frame(spark, EDGE_ROWS), "text", "n", PATH).collect()
    assert [r["n"] for r in rows] == counted(library, [r["text"] or "" for r in rows])
    empty = token_counts.with_token_count(spark.createDataFrame([], DOCS), "text", "n", PATH)
    assert empty.count() == 0
