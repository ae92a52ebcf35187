"""Queries that have to read every row of their table, against plain Python on small tables."""

import re
from collections import defaultdict

import pytest

from tidemark.plans import catalog, domain, joins, reads, registry, views  # noqa: F401


def run(spark, name, folder):
    return [tuple(r) for r in catalog.QUERIES[name](spark, folder).collect()]


PAGES = {
    1: ("a", "Report  2024\nfoot one\n1\n" + "long body " * 9 + "\nA heading\n" + "more body " * 9),
    2: ("a", "report 2024\nfoot two\n2\n" + "long body " * 9),
    3: ("b", "Report 2024\nfoot one\n3"),
    4: ("a", "Another\nFOOT  one\n4\n" + "last body " * 9),
    5: ("a", "Alone\nfoot five\n5\n" + "five body " * 9),
    6: ("b", "x" * 70 + "\n" + "y" * 70 + "\n6"),
    10: ("a", "Ten\nfoot ten\n10"),
}


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, text, "en", source, len(text)) for i, (source, text) in PAGES.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_furniture_recurs_over_all_pages(spark, pages):
    norm = lambda t: re.sub(r"\s+", " ", t).strip().lower()
    seen = defaultdict(set)
    for page, (source, text) in PAGES.items():
        for line, t in enumerate(text.split("\n")[:2]):
            seen[source, line, norm(t)].add(page)
    wanted = {(s, p, k, k == 2 or k < 2 and len(seen[s, k, norm(t)]) > 1) for p, (s, text) in PAGES.items() for k, t in enumerate(text.split("\n"))}
    got = run(spark, "d20_furniture", pages)
    assert len(got) == len(wanted) and set(got) == wanted
    assert {("a", 1, 0, True), ("a", 2, 0, True), ("a", 4, 1, True), ("b", 3, 0, False)} <= set(got)


def test_units_take_the_blocks_of_all_pages(spark, pages):
    units, index = defaultdict(list), defaultdict(int)
    for page, (source, text) in sorted(PAGES.items()):
        for line, t in enumerate(text.split("\n")):
            index[source] += len(t) < 60
            units[source, index[source]].append((page * 100000 + line, t))
    wanted = {(s, n, len(b), b[0][0], b[-1][0], "\n".join(t for _, t in b)) for (s, n), b in units.items()}
    got = run(spark, "d24_coarse_units", pages)
    assert len(got) == len(wanted) and set(got) == wanted


def test_words_are_numbered_to_the_end_of_a_text(spark, tmp_path):
    texts = {1: " ".join(f"word{i}" for i in range(90)), 2: "one  two\nthree ", 3: "", 4: None, 5: "x" * 198 + " straddling " + "y" * 300}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted = sorted((i, w, n) for i, t in texts.items() if t is not None for n, w in enumerate(t.split(" "), 1))
    got = [(r["doc_id"], r["word"], r["position"]) for r in catalog.QUERIES["j10_ordinality"](spark, str(tmp_path)).collect()]
    assert sorted(got) == wanted


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Types that only events of an id that 2, 3 or neither divides have; ids beyond 1,000; a null value."""
    folder = str(tmp_path_factory.mktemp("events"))
    rows = [(1, 7, "signup", 5.0), (3, 7, "click", 50.0), (5, 7, "view", 500.0), (6, 8, "click", 5.0), (7, 8, "error", None), (9, 9, "view", 20.0), (1003, 9, "click", 700.0), (2001, 10, "purchase", 3.0)]
    rows = [(i, u, t, v, '{"k": %d}' % i) for i, u, t, v in rows]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    return folder, rows


def test_canonical_json_of_every_event(spark, events):
    folder, rows = events
    form = '{"event":%d,"props":%s,"type":"%s","user":{"id":%d,"Été":[true,null,"a\\nb",0]}}'
    assert sorted(run(spark, "fn_canonical_json", folder)) == [(i, None if t == "error" else form % (i, props.replace(" ", ""), t, u), "not JSON" if t == "error" else None) for i, u, t, _, props in rows]


def test_predicates_see_all_types_of_a_user(spark, events):
    folder, rows = events
    types = defaultdict(set)
    for _, user, kind, _, _ in rows:
        types[user].add(kind)
    for name, wanted in [("f05_any_of", lambda t: t & {"signup", "error"}), ("f06_all_of", lambda t: t >= {"click", "view", "signup"}), ("f07_scalar_or_array", lambda t: "signup" in t)]:
        assert sorted(run(spark, name, folder)) == [(u,) for u in sorted(types) if wanted(types[u])], name


def test_union_takes_every_event(spark, events):
    folder, rows = events
    got = run(spark, "u01_union", folder)
    assert len(got) == len(set(got)) and set(got) == {(u, t) for _, u, t, _, _ in rows}
