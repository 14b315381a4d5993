"""Ids equal the library's for the BPE model; sums equal brute force for a unigram
model; texts round-trip."""

import random

import pytest
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tessera.llm import sentence_pieces
from tessera.llm.common import read_table, ship
from tests.conftest import SF_SMALL
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = [" ", "  ", "a", "an", "the", "aaa", "日本", "é", "\n", "\t", "😀", "1", "ing", "!!", "Th", "x" * 40, " " * 17, "\x00"]


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.load(PATH)


def fuzz(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 40))) for _ in range(n)]


def test_equals_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in [*fuzz(1000), "a" * 3000, " " * 100, "▁x"]:
        assert model.encode(t).tolist() == library.encode(t)


def test_round_trip(model):
    for t in [*fuzz(500), " lead", "trail ", "\n\n", ""]:
        assert model.decode(model.encode(t)) == t


def test_memory_limits_do_not_matter(model, monkeypatch):
    texts = fuzz(200, seed=4)
    want = [model.encode(t).tolist() for t in texts]
    monkeypatch.setattr(sentence_pieces, "REMEMBER", 3)
    monkeypatch.setattr(sentence_pieces, "REMEMBER_PAIRS", 3)
    fresh = sentence_pieces.Pieces(PATH)
    assert [fresh.encode(t).tolist() for t in texts] == want


@pytest.fixture
def unigram(tmp_path):
    proto = model_pb2.ModelProto()
    kind = model_pb2.ModelProto.SentencePiece
    proto.pieces.add(piece="<unk>", score=0, type=kind.UNKNOWN)
    for piece, score in {"▁": -2, "a": -3, "b": -3, "ab": -4, "aba": -6, "ba": -4, "▁a": -4, "bb": -6, "▁ab": -5}.items():
        proto.pieces.add(piece=piece, score=score, type=kind.NORMAL)
    proto.trainer_spec.model_type = model_pb2.TrainerSpec.UNIGRAM
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    path = tmp_path / "u.model"
    path.write_bytes(proto.SerializeToString())
    return sentence_pieces.Pieces(str(path))


def brute(text, scores, unknown):
    """Best (sum, segmentation) over all segmentations, longer last piece first on ties."""
    best = [(0.0, [])]
    for j in range(1, len(text) + 1):
        options = []
        for i in range(j):
            piece = text[i:j]
            if piece in scores:
                options.append((best[i][0] + scores[piece], best[i][1] + [piece]))
            elif j - i == 1:
                options.append((best[i][0] + unknown, best[i][1] + ["<unk>"]))
        top = max(s for s, _ in options)
        best.append(next(o for o in options if o[0] == top))
    return best[-1]


def test_unigram_is_the_best_sum(unigram):
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choices("ab zé", k=rng.randint(0, 14)))
        ids = unigram.encode(text)
        if text:
            _, pieces = brute("▁" + text.replace(" ", "▁"), unigram.score_of, unigram.unknown_score)
            assert [unigram.pieces[i] for i in ids] == pieces


def test_query(spark):
    ship(spark)
    got = sentence_pieces.op8_sentence_pieces(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF_SMALL, "documents").collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(got) == len(texts)
    for r in got:
        assert r["piece_ids"] == library.encode(texts[r["doc_id"]] or "")
        assert r["round_trip"] and r["n_pieces"] == len(r["piece_ids"])


def test_edge_rows(spark, model):
    ship(spark)
    coded = sentence_pieces.encode(docs_frame(spark, EDGE_ROWS), "text", "ids", PATH)
    rows = sentence_pieces.decode(coded, "ids", "back", PATH).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(r["back"] == (r["text"] or "") for r in rows)
    assert sentence_pieces.encode(spark.createDataFrame([], DOCS), "text", "ids", PATH).count() == 0
