"""Components equal brute force over all pairs of fingerprints."""

import random

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.common import components, read_table, ship
from tests.conftest import SF_SMALL
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame


def naive_fingerprint(text, k=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choices(["The ", "É", "cat ", "\t", "\x0b", "of ", " sat", "\n", " x"], k=rng.randint(0, 40)))
        assert simhash.fingerprint(text.encode(), 4) == naive_fingerprint(text)


def test_query_equals_brute_force(spark):
    ship(spark)
    docs = {r["doc_id"]: naive_fingerprint(r["text"]) for r in read_table(spark, SF_SMALL, "documents").collect()}
    want = naive_components(list(docs), lambda a, b: (docs[a] ^ docs[b]).bit_count() <= 4)
    got = simhash.op7_simhash_near_dedup(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(int(r["fingerprint"], 16) == docs[r["doc_id"]] for r in got)


@pytest.mark.parametrize("segments,run_rows", [(None, 2048), (2, 2048), (3, 7), (5, 3)])
def test_links_of_dense_and_random_fingerprints(spark, segments, run_rows):
    ship(spark)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    prints = {int(b) for b in base}
    for _ in range(150):  # balls around the centres, and chains away from them
        p = int(rng.choice(base)) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))
        prints.add(p)
    prints = sorted(prints | {int(x) for x in rng.integers(0, 2**63, 60, dtype=np.uint64)})
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "fp long, rep long")
    found = components(simhash.hamming_links(frame, 4, segments, run_rows), "a", "b").collect()
    want = naive_components(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {r["node"]: r["component"] for r in found} == {n: c for n, c in want.items() if list(want.values()).count(c) > 1}


def test_components_of_hubs_and_chains(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(999, i) for i in range(1, 80)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame([*chain, *hub, (5, 5), (7, None)], "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 80)}, 999: 1}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_edge_rows(spark):
    ship(spark)
    docs = docs_frame(spark, [*EDGE_ROWS, (20, "One", "z"), (None, "one", "z"), (None, "no such text elsewhere", "z"), (None, "no such text elsewhere", "z")])
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    of = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got}
    blank = {c for (i, f), c in of.items() if f == 0}
    assert blank == {1}  # NULL, empty and blank texts are one component
    assert {c for (i, f), c in of.items() if i in (4, 20)} == {4}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = [r["doc_id"] for r in kept.collect()]
    assert sorted(r for r in rows if r is not None) == [1, 4, 5, 6, 7, 8]
    assert rows.count(None) == 2  # of "a text without an id" and "no such text", one each
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert simhash.deduplicate(spark.createDataFrame([], DOCS)).count() == 0
