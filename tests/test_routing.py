"""Candidates of routing: the scores against plain Python, and what a source costs."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import routing
from tidemark.plans import domain

LABELS = [
    ("risk", "The", True, True, True), ("anchor", "and", False, True, False), ("scope", "de la", False, False, False), ("rare", "th onth", False, True, False),
    ("wide", "éàü😀", False, None, None), ("empty", "", False, True, False), ("none", None, True, True, True), ("pair", "abab", None, False, False),
]
SOURCES = [
    (1, "the", "body"), (2, "AND", ""), (3, "de la", None), (4, "th onto", "x"), (5, "ht noth the", "and: the"), (6, "", "de la: th onth"), (7, None, None), (8, None, "and"),
    (9, "ÉÀÜ😀", ""), (10, "éàü😀 x", ""), (11, "é à ü😀éà", "a"), (12, "ab", "b"), (13, "baba", ""), (14, "abba abba", ""), (15, "month onth th" * 300, "x" * 5000), (16, "ntho ", "th:"),
]


def likeness(title, name):
    if min(len(title), len(name)) < 4:
        return 0.0
    pairs = lambda text: {text[i : i + 2] for i in range(len(text) - 1)}
    return 0.6 * (len({*title} & {*name}) / len({*name})) + 0.4 * (2 * len(pairs(title) & pairs(name)) / (len(pairs(title)) + len(pairs(name))))


def expected(unit, title, body, key, name, is_risk, in_scope, exclusive):
    if name is None:
        return None
    name, holds = name.lower(), lambda text, part: text is not None and part in text.lower()
    alike = 0.0 if title is None else likeness(title.lower(), name)
    said = (
        (1200 if is_risk else 1000 if in_scope else 700) if title is not None and title.lower() == name
        else 650 if holds(title, name) else 900 if holds(body, name + ":") else 300 + len(name) if holds(body, name) else 500 + math.floor(alike * 100) if alike >= 0.6 else 0
    )
    return (unit, key, exclusive, said, "text" if holds(title, name) or holds(body, name) else "similarity") if said >= 55 else None


@pytest.fixture(scope="module")
def scored(spark):
    sources = spark.createDataFrame(SOURCES, "unit_id long, title string, body string")
    return routing.candidates(sources, spark.createDataFrame(LABELS, "label_key string, name string, is_risk boolean, in_scope boolean, exclusive boolean"))


def test_scores_are_those_of_plain_python(scored):
    wanted = [e for s in SOURCES for label in LABELS if (e := expected(*s, *label))]
    assert {e[4] for e in wanted} == {"text", "similarity"}
    assert sorted(map(tuple, scored.collect()), key=repr) == sorted(wanted, key=repr)


def test_a_title_is_cut_once_a_source_and_not_once_a_label(scored):
    """Each text is lowered in one place, below the labels; titles are cut there too, and the join compares nothing."""
    plan = scored._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert [sum(line.count(f"lower({c}#") for line in plan) for c in ("title", "body")] == [1, 1]
    [unfolded] = [k for k, line in enumerate(plan) if "Generate" in line]
    [join] = [line for line in plan if "Join" in line]
    assert "split" not in join and not any("split(title#" in line for line in plan[:unfolded]) and any("split(title#" in line for line in plan[unfolded:])


def test_a_text_is_cut_into_characters_once(spark, scored):
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("split(title#") == 1
    texts = ["", "a", "ab", "aaa", "é😀é", None]
    pairs = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.grams(F.col("t"), 2))
    assert [(t, p if p is None else sorted(p)) for t, p in pairs.collect()] == [(t, None if t is None else sorted({t[i : i + 2] for i in range(len(t) - 1)})) for t in texts]


def test_sources_are_the_first_line_and_the_rest(spark, tmp_path):
    texts = ["one", "one\ntwo", "\nall body", "title\n", "\n", "", "\n\nx", "é😀\nü\nz", "a\r\nb", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sources = domain._sources(spark, str(tmp_path))
    wanted = [(i, None, None) if t is None else (i, *t.partition("\n")[::2]) for i, t in enumerate(texts)]
    assert sorted(map(tuple, sources.collect())) == wanted
    assert "regexp" not in sources._jdf.queryExecution().optimizedPlan().toString()
