"""Licence scans: Dice coefficient over word bigrams, in DataFrame functions only.

A text's units are compared with licence templates: the whole text, its paragraphs, lines
and sentences (as a full stop, question or exclamation mark and a blank end them), and
every run of two or more consecutive lines that has not more words than the template's size
allows. So licences of several paragraphs are found inside longer texts. Units
and templates are normalised alike (lower case, one spelling of "license", anything
but a-z and 0-9 a gap) and become sets of word bigrams; a unit matches at a coefficient of
``threshold`` or more.

Sizes bound the coefficient: sets a and b can only reach t if neither is larger than
(2 - t) / t times the other, and then they share at least t / (2 - t) of the template's
bigrams. Two prunings follow. A template is a candidate for a text only if the text has as many
of its words as that share of its bigrams must cover (``needed_words``); most texts have
no candidate and make no bigram. And bigrams are only made of units whose numbers of words allow
some candidate, and only candidates whose size allows it are intersected.

Everything happens in the row of the text; templates are a literal of the plan
(their number is the caller's, a few dozen). Defined results: NULL and empty texts
match nothing; texts of any length are scanned whole; of equal coefficients the first
licence in name order wins; repeated rows are judged each; an empty table gives an empty
result; the given columns pass through, and one named like a result is an error.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table, temp_column
from tessera.llm.license_texts import TEMPLATES

THRESHOLD = 0.8
OUTPUT = ("license", "dice", "licenses")


def template_bigrams(text: str) -> list[str]:
    w = re.sub(r"[^a-z0-9]+", " ", text.lower()).replace("licence", "license").split()
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def needed_words(grams: list[str], threshold: float) -> tuple[list[str], int]:
    """The words of a template's bigrams, and how many of them any set of bigrams must have that
    reaches ``threshold``: it lacks at most d bigrams, and words with all bigrams among d
    have at most 2 d places in them together."""
    places = Counter(w for g in grams for w in set(g.split(" ")))
    lacking = len(grams) - math.ceil(threshold * len(grams) / (2 - threshold) - 1e-9)
    room, gone = 2 * lacking, 0
    for n in sorted(places.values()):
        room -= n
        if room < 0:
            break
        gone += 1
    return sorted(places), len(places) - gone


def _table(templates: list[tuple[str, str]], threshold: float) -> list[tuple[str, list[str], list[str], int]]:
    """(licence, bigrams, words, words needed) of the templates that have a bigram."""
    table = [(name, template_bigrams(text)) for name, text in templates]
    return [(name, grams, *needed_words(grams, threshold)) for name, grams in table if grams]


def _words(unit: F.Column) -> F.Column:
    return F.split(F.trim(F.regexp_replace(unit, "[ \n]+", " ")), " ", -1)


def scan(
    docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` plus ``license`` (best match, NULL without one), ``dice`` and
    ``licenses`` (all matching licences in order, comma-separated)."""
    clash = {c.lower() for c in docs.columns} & set(OUTPUT)
    if clash:
        raise ValueError(f"columns named like the result's: {sorted(clash)}")
    table = _table(templates or TEMPLATES, threshold)
    ratio = (2 - threshold) / threshold * (1 + 1e-9)  # rounding must not prune a match
    known = F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(len(grams)).alias("n"),
            F.array(*map(F.lit, own)).alias("words"), F.lit(need).alias("need"),
        )
        for name, grams, own, need in table
    ])
    norm, found, likely, mine = (temp_column(name) for name in ("norm", "found", "likely", "mine"))
    plain = lambda c: F.replace(F.regexp_replace(c, "[^a-z0-9\n]+", " "), F.lit("licence"), F.lit("license"))
    lower = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    # The text's words that templates have, found once; most texts have too few of them for any template.
    own = F.split(F.replace(lower, F.lit("licence"), F.lit("license")), "[^a-z0-9]+", -1)
    any_words = F.array(*map(F.lit, sorted({w for _, _, words, _ in table for w in words}))).cast("array<string>")
    out = docs.withColumn(mine, F.array_intersect(own, any_words))
    fits = lambda t: (F.size(F.col(mine)) >= t["need"]) & (F.size(F.array_intersect(t["words"], F.col(mine))) >= t["need"])
    out = out.withColumn(likely, F.filter(known, fits))
    out = out.withColumn(norm, F.when(F.size(F.col(likely)) > 0, plain(lower)))
    sizes = F.transform(F.col(likely), lambda t: t["n"])
    least, most = F.array_min(sizes) / ratio, F.array_max(sizes) * ratio

    def grams_of(words: F.Column) -> F.Column:
        n = F.size(words) - 1
        return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))

    def matches(grams: F.Column, words: F.Column | None = None) -> F.Column:
        def can(t: F.Column) -> F.Column:
            size = (t["n"] <= F.size(grams) * ratio) & (F.size(grams) <= t["n"] * ratio)
            return size if words is None else size & (words - 1 <= t["n"] * ratio)

        scores = F.transform(F.filter(F.col(likely), can), lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + t["n"])).alias("d"), t["name"].alias("name")
        ))
        return F.filter(scores, lambda m: m["d"] <= -threshold)

    # Units of one kind each.
    text = F.col(norm)
    sentences = F.transform(F.split(lower, "[.!?][ \t]+|\n", -1), plain)
    units = F.array_distinct(F.concat(F.array(text), F.split(text, "\n[ ]*\n[ \n]*", -1), F.split(text, "\n", -1), sentences))
    fitting = F.filter(F.transform(units, _words), lambda w: (F.size(w) - 1 >= least) & (F.size(F.array_distinct(w)) - 1 <= most))
    single = F.flatten(F.transform(F.transform(fitting, grams_of), lambda g: matches(g)))
    # Runs of lines with words, line by line; a run grows until it has too many words.
    lines = F.filter(F.transform(F.split(text, "\n", -1), _words), lambda w: w[0] != "")
    kind = "array<struct<d: double, name: string>>"

    def runs(state: F.Column, at: F.Column) -> F.Column:
        after = F.slice(state["lines"], at, F.floor(most + 2).cast("int"))  # each line has a word at least
        upto = F.transform(after, F.size)
        ends = F.filter(F.sequence(F.lit(2), F.greatest(F.size(after), F.lit(2))), lambda k: k <= F.size(after))
        total = lambda k: F.aggregate(F.slice(upto, 1, k), F.lit(0), lambda a, n: a + n)
        ends = F.filter(ends, lambda k: (total(k) - 1 <= most) & (total(k) - 1 >= least))
        here = F.flatten(F.transform(ends, lambda k: matches(grams_of(F.flatten(F.slice(after, 1, k))), total(k))))
        return F.struct(state["lines"].alias("lines"), F.array_distinct(F.concat(state["found"], here)).alias("found"))

    starts = F.sequence(F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1)))
    several = F.aggregate(starts, F.struct(lines.alias("lines"), F.array().cast(kind).alias("found")), runs, lambda s: s["found"])
    everything = F.when(F.size(likely) > 0, F.array_sort(F.array_distinct(F.concat(single.cast(kind), several)))).otherwise(F.array().cast(kind))
    out = out.withColumn(found, everything)
    best = F.try_element_at(F.col(found), F.lit(1))
    return out.withColumns({
        "license": best["name"],
        "dice": -best["d"],
        "licenses": F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(found, lambda m: m["name"])))),
    }).drop(norm, found, likely, mine)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and all licences of every document."""
    scanned = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "license", F.round("dice", 6).alias("dice"), "licenses")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NEEDED = {t: needed_words(template_bigrams(x), THRESHOLD)[1] for t, (_, x) in enumerate(TEMPLATES)}

SQL = rf"""
WITH t AS (
  SELECT t, name, need, len(g) AS n, g, w AS all_words FROM (
    SELECT t, name, need, w, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM (
      SELECT t, name, need, string_split(trim(replace(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'), 'licence', 'license')), ' ') AS w
      FROM (VALUES {", ".join(f"({t}, {_quoted(n)}, {_NEEDED[t]}, {_quoted(x)})" for t, (n, x) in enumerate(TEMPLATES))}) v(t, name, need, x)
    )
  )
), d AS (
  SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS low,
         replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\n]+', ' ', 'g'), 'licence', 'license') AS x FROM documents
), has AS (
  SELECT DISTINCT r, unnest(string_split_regex(x, '[ \n]+')) AS word FROM d
), likely AS (
  SELECT r, t FROM has JOIN (SELECT DISTINCT t, need, unnest(all_words) AS word FROM t) USING (word) GROUP BY r, t, need HAVING count(*) >= need
), cand AS (
  SELECT d.*, l.most FROM d JOIN (SELECT r, max(n) AS most FROM likely JOIN t USING (t) GROUP BY r) l USING (r)
), u AS (
  SELECT DISTINCT r, unnest([x] || string_split_regex(x, '\n[ ]*\n[ \n]*') || string_split(x, chr(10)) || list_transform(
    string_split_regex(low, '[.!?][ \t]+|\n'), lambda s: replace(regexp_replace(s, '[^a-z0-9\n]+', ' ', 'g'), 'licence', 'license')
  )) AS u FROM cand
), w AS (
  SELECT r, string_split(trim(regexp_replace(u, '[ \n]+', ' ', 'g')), ' ') AS w, 0 AS run FROM u
), ls AS (
  SELECT r, most, row_number() OVER (PARTITION BY r ORDER BY i) AS i, w FROM (
    SELECT r, most, i, string_split(trim(l), ' ') AS w
    FROM (SELECT r, most, unnest(string_split(x, chr(10))) AS l, unnest(range(len(string_split(x, chr(10))))) AS i FROM cand)
  ) WHERE w[1] <> ''
), sums AS (
  SELECT r, most, i, w, sum(len(w)) OVER (PARTITION BY r ORDER BY i) AS upto FROM ls
), runs AS (
  SELECT a.r, a.i, b.i AS j FROM sums a JOIN sums b
  ON a.r = b.r AND b.i > a.i AND b.i <= a.i + 1.5 * a.most + 2 AND b.upto - a.upto + len(a.w) - 1 <= 1.5 * a.most
), joined AS (
  SELECT runs.r, flatten(list(s.w ORDER BY s.i)) AS w FROM runs JOIN sums s ON s.r = runs.r AND s.i BETWEEN runs.i AND runs.j
  GROUP BY runs.r, runs.i, runs.j
), g AS (
  SELECT r, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g, run, len(w) - 1 AS size
  FROM (SELECT r, w, run FROM w UNION ALL SELECT r, w, 1 AS run FROM joined)
  WHERE len(w) > 1 AND len(list_distinct(w)) <= (SELECT 1 + 1.5 * max(n) FROM t)
), m AS (
  SELECT g.r, name, 2 * len(list_intersect(g.g, t.g))::DOUBLE / (len(g.g) + t.n) AS dice
  FROM g JOIN likely USING (r) JOIN t ON t.t = likely.t AND 2 * len(g.g) <= 3 * t.n AND 2 * t.n <= 3 * len(g.g)
  WHERE run = 0 OR 2 * size <= 3 * t.n
), b AS (
  SELECT r, arg_min(name, (-dice, name)) AS license, max(dice) AS dice,
         string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM m WHERE dice >= {THRESHOLD} GROUP BY r
)
SELECT d.doc_id, b.license, round(b.dice, 6) AS dice, coalesce(b.licenses, '') AS licenses FROM d LEFT JOIN b USING (r)
"""
