"""Exact neighbours, calibration, held-out accuracy and edge rows."""

import math
import pickle
from collections import Counter
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tessera.llm.common import read_table, ship
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def index(spark):
    ship(spark)
    docs = read_table(spark, SF_MID, "documents")
    return toxicity.learn(docs, read_table(spark, SF_MID, "labels"), min_chi2=5.0, min_odds=1.5)


def vectors(index):
    """The examples as dense rows."""
    dense = np.zeros((len(index.ids), len(index.idf)))
    for e in range(len(index.ids)):
        at = slice(index.vector_offsets[e], index.vector_offsets[e + 1])
        dense[e, index.vector_terms[at]] = index.vector_values[at]
    return dense


def nearest(index, text, k):
    return index.nearest(index.vectors([text.encode()]), 1, k)[0][0]


def same(got, cosines, k, tolerance=1e-9):
    """The k best of dense cosines; sums may differ in their last digits, so near ties are left out."""
    want = [e for e in np.lexsort((np.arange(len(cosines)), -cosines))[:k] if cosines[e] > tolerance]
    got_c, got_e = got
    assert np.allclose(got_c[: len(want)], cosines[want], atol=tolerance) and len(got_c) >= len(want)
    last = cosines[want[-1]] if want else 0
    assert {e for e, c in zip(got_e, got_c) if c > last + tolerance} == {e for e in want if cosines[e] > last + tolerance}


def test_neighbours_are_exact(spark, index):
    dense = vectors(index)
    texts = [r["text"] for r in read_table(spark, SF_MID, "documents").limit(300).collect()]
    asked = 0
    for some in toxicity._slices([t.encode() for t in texts]):
        of, term, w = index.vectors(some)
        got, _ = index.nearest((of, term, w), len(some), 25)
        for t in range(len(some)):
            q = np.zeros(dense.shape[1])
            q[term[of == t]] = w[of == t]
            same(got[t], np.round(dense @ q, 12), 25)
            asked += bool(q.any())
    assert asked > 50


def plain_tf_idf(docs, labels, index):
    """Term weights of the examples and of any text, counted from the texts by plain Python."""
    known, texts = index.lexicon.vocabulary, {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    bag = lambda t: Counter(x for w in toxicity.words_of(t) for x in toxicity.terms(w) if x in known)
    df = Counter(x for t in texts.values() for x in bag(t))
    idf = {x: math.log((1 + len(texts)) / (1 + df[x])) + 1 for x in known}

    def vector(t):
        v = {x: (1 + math.log(n)) * idf[x] for x, n in bag(t).items()}
        size = math.sqrt(sum(a * a for a in v.values()))
        return {x: a / size for x, a in v.items()}

    return vector, [vector(texts[i]) for i in index.ids]


def test_neighbours_equal_cosines_from_the_texts(spark):
    ship(spark)
    docs, labels = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels")
    index = toxicity.learn(docs, labels)
    vector, examples = plain_tf_idf(docs, labels, index)
    for text in [r["text"] for r in docs.limit(80).collect()]:
        q = vector(text.encode())
        cosines = np.array([sum(a * e.get(x, 0.0) for x, a in q.items()) for e in examples])
        same(nearest(index, text, 7), cosines, 7, 1e-6)


def test_blocks_that_cannot_matter_are_not_scored(spark, index):
    texts = [r["text"].encode() for r in read_table(spark, SF_MID, "documents").limit(200).collect()]
    v = index.vectors(texts)
    for k in (1, 5):
        _, scored = index.nearest(v, len(texts), k)
        assert 0 < scored < 0.9 * len(texts) * index.blocks, (k, scored)


def test_block_maxima_bound_their_postings(index, monkeypatch):
    monkeypatch.setattr(toxicity, "HEAVY", 50)
    index.__dict__.pop("_heavy", None), index.__dict__.pop("most", None)
    dense, row = vectors(index), index._heavy[0]
    heavy = np.flatnonzero(row >= 0)
    assert len(heavy) == 50 and (np.count_nonzero(dense[:, heavy], axis=0).min() >= np.count_nonzero(dense[:, row < 0], axis=0).max())
    for b in range(index.blocks):
        assert np.allclose(index.most[:, b], dense[b * toxicity.BLOCK : (b + 1) * toxicity.BLOCK, heavy].max(axis=0))
    # With few heavy terms or all of them the neighbours are the same.
    text = b"a text of some words " * 3
    few = index.nearest(index.vectors([text]), 1, 9)[0][0]
    monkeypatch.undo()
    index.__dict__.pop("_heavy", None), index.__dict__.pop("most", None)
    many = index.nearest(index.vectors([text]), 1, 9)[0][0]
    assert few[0].tolist() == many[0].tolist() and few[1].tolist() == many[1].tolist()


def test_lexicon_finds_every_term_and_keeps_no_words():
    """The terms of a word are those the vocabulary has, whichever of its stems it lacks; words met leave nothing behind."""
    known = [b"walking", b"~walk", b"~walkin", b"run", b"~runn", b"~runni", "größere".encode(), "~größ".encode(), "~größer".encode(), b"~lone"]
    lexicon = toxicity.Lexicon({t: i for i, t in enumerate(known)})
    copy = pickle.loads(pickle.dumps(lexicon))
    size = len(pickle.dumps(vars(lexicon)))
    texts = ["Walking, walking walker wal!", "", None, "running run runs runn", "größere größten größ lonely über", "x" * 9, " ".join(f"w{i} lone{i}" for i in range(3000))]
    texts = [t if t is None else t.encode() for t in texts]
    want = []
    for t in texts:
        bag = Counter(x for w in toxicity.words_of(t) for x in toxicity.terms(w) if x in known)
        want.append({known.index(x): n for x, n in bag.items()})
    for some in (lexicon, copy):
        text, term, n = some.counts(texts)
        assert [dict(zip(term[text == i].tolist(), n[text == i].tolist())) for i in range(len(texts))] == want
        assert Counter(some.present(texts).tolist()) == Counter(i for w in want for i in w)
    assert len(pickle.dumps(vars(lexicon))) == size


def test_neighbours_need_no_vectors(index):
    """Once its postings stand, the index searches without the examples' vectors: a copy without them finds the same."""
    texts = [b"a text of some words " * 3, b"", b"some other words of a text"]
    want = index.nearest(index.vectors(texts), 3, 9)[0]
    bare = replace(index)
    bare.search_only()
    bare.search_only()
    assert not len(bare.vector_terms) and len(index.vector_terms)
    for (c, e), (d, f) in zip(want, bare.nearest(bare.vectors(texts), 3, 9)[0]):
        assert c.tolist() == d.tolist() and e.tolist() == f.tolist()


def test_search_needs_postings_alone(index):
    """What is sent to score holds each posting once; a worker between tasks holds no matrix."""
    texts = [b"a text of some words " * 3, b"", b"some other words of a text"]
    want = index.nearest(index.vectors(texts), 3, 9)[0]
    bare = replace(index)
    bare.search_only()
    sent = pickle.loads(pickle.dumps(bare))
    for _ in range(2):
        got = sent.nearest(sent.vectors(texts), 3, 9)[0]
        assert [(c.tolist(), e.tolist()) for c, e in got] == [(c.tolist(), e.tolist()) for c, e in want]
        sent.rest()
        arrays = [x for v in sent.__dict__.values() for x in (v if isinstance(v, tuple) else [v]) if isinstance(x, np.ndarray)]
        assert max(x.nbytes for x in arrays) <= max(index.vector_values.nbytes, 8 * (len(index.idf) + 1))
    some = np.array([3, 0, 7])
    place, term, value = sent.own_vectors(some)
    dense = np.zeros((3, len(index.idf)))
    dense[place, term] = value
    assert (dense == vectors(index)[some]).all() and (np.diff(place) >= 0).all()


def test_texts_are_taken_from_a_batch_a_few_at_a_time(spark, index, monkeypatch):
    """Scores don't depend on how many texts are held at a time, or forgotten."""
    docs = docs_frame(spark, EDGE_ROWS).select("doc_id", "text").unionByName(read_table(spark, SF_SMALL, "documents").select("doc_id", "text"))
    rows = lambda: sorted(map(str, toxicity.score(docs.coalesce(1), index).select("doc_id", "toxicity").collect()))
    want = rows()
    monkeypatch.setattr(toxicity, "HELD", 7)
    monkeypatch.setattr(toxicity, "REMEMBER", 20)
    assert rows() == want and len(want) > 100


def test_labelled_copies(spark):
    """Equal texts are one example with their mean label; near copies one, but not across labels."""
    text = " ".join(f"w{i}" for i in range(200))
    near, other = text + " tail", " ".join(f"w{i}" for i in range(5)) + " " + " ".join(f"v{i}" for i in range(200))
    frame = pd.DataFrame([(5, 0.0, text), (1, 0.0, text), (2, 1.0, text), (3, 0.0, near), (4, 1.0, near), (6, 1.0, near + " x"), (7, 0.0, other)], columns=["id", "y", "t"])
    frame["t"] = frame["t"].str.encode("utf-8")
    got = {r.id: r.y for r in toxicity._distinct(frame).itertuples()}
    assert got == {1: 1 / 3, 3: 0.5, 6: 1.0, 7: 0.0}


def test_isotonic():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1.0]), np.ones(5))
    assert x.tolist() == [0.1, 0.1, 0.2, 0.5, 0.9, 0.9]
    assert np.allclose(y, [0, 0, 1 / 3, 1 / 3, 1, 1])
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1.0]), np.ones(5), 4)
    assert x.tolist() == [0.1, 0.5, 0.9, 0.9] and np.allclose(y, [1 / 4, 1 / 4, 1, 1])  # the ends stay


def test_held_out_accuracy_and_contract(spark):
    ship(spark)
    rows = toxicity.op4_toxicity(spark, SF_MID)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = read_table(spark, SF_MID, "labels")
    r = rows.join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("accuracy"),
        F.avg(F.when(F.col("predicted") == 1, F.col("toxic"))).alias("precision"),
        F.min("score").alias("low"), F.max("score").alias("high"),
    ).first()
    assert r["accuracy"] > 0.9 and r["precision"] > 0.9 and 0 <= r["low"] <= r["high"] <= 1
    assert rows.where("predicted <> int(score >= 0.3) or held_out <> (crc32(string(doc_id)) % 4 = 2)").count() == 0


def test_held_out_labels_teach_nothing(spark):
    ship(spark)
    docs = read_table(spark, SF_MID, "documents")
    labels = read_table(spark, SF_MID, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.learn(docs, which, label_weights=True) for which in (labels, flipped))
    assert a.ids.tolist() == b.ids.tolist() and a.rates.tolist() == b.rates.tolist() and a.empty_rate == b.empty_rate


def test_planted_words_are_caught_and_clean_texts_left(spark):
    ship(spark)
    clean = [(i, f"plain talk number {i} about w{i % 7} and w{i % 5}", "s") for i in range(400)]
    toxic = [(1000 + i, f"plain talk number {i} about vilex{'abcdefg'[i % 7]} and w{i % 5}", "s") for i in range(100)]
    docs = docs_frame(spark, clean + toxic)
    labels = spark.createDataFrame([(i, 1, int(i >= 1000)) for i, _, _ in clean + toxic], LABELS)
    index = toxicity.learn(docs, labels, label_weights=True)
    fresh = docs_frame(spark, [(1, "calm words of w3", "s"), (2, "never seen vilexquz here", "s"), *EDGE_ROWS])
    scored = toxicity.score(fresh, index).collect()
    assert len(scored) == fresh.count()
    got = [r["toxicity"] for r in scored]
    assert got[0]["score"] < 0.1 and got[1]["score"] > 0.8  # by its stem
    assert all(i >= 1000 for i in got[1]["ids"]) and len(got[1]["ids"]) == 3
    assert all(g["score"] < 0.1 for g in got[2:])


def test_without_labels_or_documents(spark):
    ship(spark)
    none = toxicity.learn(docs_frame(spark, EDGE_ROWS), spark.createDataFrame([], LABELS))
    assert {r["toxicity"]["score"] for r in toxicity.score(docs_frame(spark, EDGE_ROWS), none).collect()} == {0.0}
    one = toxicity.learn(docs_frame(spark, EDGE_ROWS), spark.createDataFrame([(5, 1, 1), (7, 1, 1), (4, 1, None)], LABELS))
    assert all(0 <= r["toxicity"]["score"] <= 1 for r in toxicity.score(docs_frame(spark, EDGE_ROWS), one).collect())
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.score(empty, toxicity.learn(empty, spark.createDataFrame([], LABELS))).count() == 0


@pytest.mark.parametrize("folder,least", [(SF_SMALL, 0.5), (SF_MID, 0.6)])
def test_small_tables_find_toxic_texts(spark, folder, least):
    """With the production parameters every example has terms, and held-out toxic texts are found."""
    ship(spark)
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    index = toxicity.learn(docs, labels)
    assert len(index.idf) > 1000 and (np.diff(index.vector_offsets) > 0).all()
    held = toxicity.op4_toxicity(spark, folder).where("held_out").join(labels.where("toxic = 1"), "doc_id")
    assert held.agg(F.avg("predicted")).first()[0] >= least


def test_rare_toxic_terms_count(spark):
    """A term of three toxic texts among hundreds of labelled ones decides."""
    ship(spark)
    clean = [(i, f"plain talk number {i} about w{i % 7} and w{i % 5}", "s") for i in range(600)]
    toxic = [(1000 + i, f"plain talk number {i} about {'zorgle' if i < 3 else 'vilexq'} and w{i % 5}", "s") for i in range(60)]
    docs = docs_frame(spark, clean + toxic)
    index = toxicity.learn(docs, spark.createDataFrame([(i, 1, int(i >= 1000)) for i, _, _ in clean + toxic], LABELS), label_weights=True)
    r = toxicity.score(docs_frame(spark, [(1, "you zorgle", "s")]), index).first()["toxicity"]
    assert r["score"] > 0.5 and sorted(r["ids"]) == [1000, 1001, 1002]
