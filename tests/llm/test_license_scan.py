"""Matches equal a comparison of every unit with every template."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import license_scan
from tessera.llm.license_texts import TEMPLATES
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

MIT = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 200)


def brute(text, threshold=license_scan.THRESHOLD):
    """Every unit with every template, without any pruning but the word limit of runs."""
    low = (text or "").lower()
    text = re.sub(r"[^a-z0-9\n]+", " ", low)
    lines = [line.split() for line in text.split("\n") if line.strip()]
    units = [(u, None) for u in {text, *re.split(r"\n[ ]*\n[ \n]*", text), *text.split("\n"), *re.split(r"[.!?][ \t]+|\n", low)}]
    longest = 1.5 * max(len(license_scan.template_bigrams(t)) for _, t in TEMPLATES)
    for i in range(len(lines)):
        words = list(lines[i])
        for more in lines[i + 1 :]:
            words += more
            if len(words) - 1 > longest:
                break
            units.append((" ".join(words), len(words) - 1))
    table = [(name, set(license_scan.template_bigrams(t))) for name, t in TEMPLATES]
    found = set()
    for unit, run in units:
        a = set(license_scan.template_bigrams(unit))
        for name, b in table:
            if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold and (run is None or run <= 1.5 * len(b)):
                found.add((-2 * len(a & b) / (len(a) + len(b)), name))
    best = min(found, default=(None, None))
    return best[1], None if best[0] is None else round(-best[0], 9), ",".join(sorted({n for _, n in found}))


def template(name):
    return max((t for n, t in TEMPLATES if n == name), key=len).strip()


PROSE = "\n".join(f"Line {i} of a longer text about many things and a few others." for i in range(80))
# Licences as they stand in files: paragraphs, wrapped lines, comment marks, inside long texts.
LAYOUTS = [
    ("MIT", PROSE + "\n\nMIT License\n\nCopyright (c) 2020 Someone\n\n" + re.sub(r"(conditions:|Software\.(?= THE))", r"\1\n\n", template("MIT").replace("\n", " ")) + "\n\n" + PROSE),
    ("MIT", PROSE + "\n" + "\n".join("# " + line for line in template("MIT").split("\n")) + "\n" + PROSE),
    ("BSD-3-Clause", PROSE + "\n\n" + re.sub(r"(?=[123]\. [RN]|THIS SOFTWARE IS)", "\n\n", template("BSD-3-Clause").replace("\n", " ")) + "\n\n" + PROSE),
    ("GPL-3.0", PROSE + "\n\n" + template("GPL-3.0").replace("This program is distributed", "\n\nThis program is distributed") + "\n\n" + PROSE),
    ("GPL-2.0", PROSE + "\n\n * " + template("GPL-2.0").replace("\n", "\n * ") + "\n\n" + PROSE),
    ("LGPL-2.1", PROSE + "\n\n" + template("LGPL-2.1") + "\n\n" + PROSE), ("LGPL-3.0", template("LGPL-3.0")), ("AGPL-3.0", template("AGPL-3.0") + "\n" + PROSE),
    ("Unlicense", PROSE + "\n" + template("Unlicense")), ("CC0-1.0", template("CC0-1.0") + "\n" + PROSE),
    ("MIT", "A tool for all. Licensed under the MIT License. It holds what it says."), ("Apache-2.0", PROSE + " Licensed under the Apache License 2.0! See below."),
]


@pytest.mark.parametrize("name, text", LAYOUTS)
def test_units_find_licences_in_long_texts(name, text):
    assert brute(text)[0] == name


TEXTS = [
    "Released under the MIT License.", "intro\nLicensed under CC BY-NC 4.0.\nend", MIT, "Copyright (c) 2020 Someone\n\n" + MIT,
    "some prose " * 30 + "\n\n" + MIT + "\n\n" + "more prose " * 30, MIT.replace("Software", "Program"), "released under the mit licence",
    "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "Released under the XYZ License",
    "the MIT License is released under", "LICENSED UNDER CC BY SA 4 0", "no licence here at all",
]


def test_equals_brute_force(spark):
    texts = [*TEXTS, *(t for _, t in LAYOUTS)]
    rows = [*((i, t, "s") for i, t in enumerate(texts)), *EDGE_ROWS]
    got = license_scan.scan(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r["text"])
        assert (r["license"], None if r["dice"] is None else round(r["dice"], 9), r["licenses"]) == want
    assert [r["license"] for r in got][:3] == ["MIT", "CC-BY-NC-4.0", "MIT"]
    assert [r["license"] for r in got][len(TEXTS) : len(texts)] == [n for n, _ in LAYOUTS]


def test_names_of_the_result_are_refused(spark):
    with pytest.raises(ValueError, match="license"):
        license_scan.scan(docs_frame(spark, [(1, "x", "s")]).withColumn("License", F.lit(1)))


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_needed_words_are_a_lower_bound(name, text):
    """No set of bigrams that reaches the threshold has fewer of the words (tried by greedy and random removals)."""
    grams = license_scan.template_bigrams(text)
    words, need = license_scan.needed_words(grams, 0.8)
    lacking = len(grams) - math.ceil(2 * len(grams) / 3 - 1e-9)
    rng = random.Random(name)
    for _ in range(20):
        left = list(grams)
        for _ in range(lacking):  # take out a bigram of the word with the fewest left
            count = Counter(w for g in left for w in set(g.split()))
            w = min(count, key=lambda w: (count[w], rng.random()))
            left.remove(rng.choice([g for g in left if w in g.split()]))
        assert len({w for g in left for w in g.split()}) >= need


def test_ties_and_empty(spark):
    same = [("b", "one two three four"), ("a", "one two three four")]
    got = license_scan.scan(docs_frame(spark, [(1, "One two THREE four", "s")]), templates=same).first()
    assert (got["license"], got["dice"], got["licenses"]) == ("a", 1.0, "a,b")
    # A coefficient of exactly the threshold at the size bound: 2 * 10 / (10 + 15)
    long = " ".join(f"w{i}" for i in range(16))
    edge = license_scan.scan(docs_frame(spark, [(1, long, "s")]), templates=[("x", " ".join(f"w{i}" for i in range(11)))]).first()
    assert (edge["license"], edge["dice"]) == ("x", 0.8)
    assert license_scan.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_only_texts_with_a_candidate_are_normalised(spark):
    """The words that templates have are looked up once for a text; its gaps are replaced under a condition only."""
    plan = license_scan.scan(docs_frame(spark, [(1, "x", "s")]))._jdf.queryExecution().optimizedPlan().toString()
    first = [line for line in plan.split("\n") if "array_intersect" in line][-1]  # the project next to the rows
    assert first.count("array_intersect") == 1 and "regexp_replace" not in first
