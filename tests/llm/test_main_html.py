"""Main text extraction: marks that speak of a page, broken markup, hostile pages, and the scores against a plain reckoning."""

import random
import time

import pytest

from tidemark.llm import mainhtml

PARAGRAPH = "One sentence, then another, and more words follow here. " * 4
ARTICLE = f"<p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
TEXT = " ".join([PARAGRAPH.strip()] * 2)
COMMENTS = "<div class='comments'>" + "<p>I think, well, no, yes, maybe.</p>" * 12 + "</div>"


@pytest.mark.parametrize(
    "opening, closing",
    [
        ("<div style='overflow:hidden'>", "</div>"),
        ('<article style="overflow: hidden">', "</article>"),
        ("<div data-id='search'>", "</div>"),
        ("<div class='content has-sidebar'>", "</div>"),
        ("<div class='post comments-open'>", "</div>"),
        ("<div class='related'>", "</div>"),
        ("<form action='/x'>", "</form>"),
        ("<div title='> class=ad'>", "</div>"),
        ("<section id=widget-area-main>", "</section>"),
    ],
)
def test_marks_of_what_holds_the_text_do_not_drop_it(opening, closing):
    assert mainhtml.main_text(opening + ARTICLE + closing) == TEXT
    page = f"<nav><a href=/>Home</a></nav>{opening}{ARTICLE}{closing}<div class=ad>Buy, buy now.</div><footer>(c)</footer>"
    assert mainhtml.main_text(page) == TEXT
    if "related" not in opening and "form" not in opening:
        assert mainhtml.main_text(page + COMMENTS) == TEXT


@pytest.mark.parametrize(
    "part",
    [
        "<div class=ad>Buy, buy now.</div>",
        "<div class='box  AD '>Buy</div>",
        "<div id='cookie-notice'>We use them, all of them.</div>",
        "<section class='comment-list'><p>Great, really, good.</p></section>",
        "<div role=complementary>Aside, from this</div>",
        "<div hidden>Unseen</div>",
        "<div style='color:red; display : none'>Unseen</div>",
        "<div aria-hidden=TRUE>Unseen</div>",
        "<aside>Beside</aside>",
        "<form><p>Your name, please</p></form>",
        "<script>if (a < b) { '</p>' }</script>",
        "<svg><text>drawn</text></svg>",
        "<div class='siteFooter'>(c)</div>",
        "<!-- <p>no, never</p> -->",
    ],
)
def test_marked_parts_of_an_article_go(part):
    assert mainhtml.main_text(f"<article><p>{PARAGRAPH}</p>{part}<p>{PARAGRAPH}</p></article>") == TEXT
    assert mainhtml.main_text(f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>{part}</div>") == TEXT


def test_reader_comments_that_outgrow_the_article_go():
    assert mainhtml.main_text(f"<div class=post><p>{PARAGRAPH}</p></div>{COMMENTS}") == PARAGRAPH.strip()


def test_links_and_broken_markup():
    assert mainhtml.main_text(f"<p>{PARAGRAPH}go <a href='/hidden/x' rel=search>linked words</a> on</p>") == PARAGRAPH + "go linked words on"
    assert mainhtml.main_text('<p class="x>abc') == "abc"
    assert mainhtml.main_text('<p class="x>abc</p><p id=\'y>def</p>') == "abc def"
    assert mainhtml.main_text("a < b <3 c <") == "a < b <3 c"
    assert mainhtml.main_text("one <b") == "one" and mainhtml.main_text("one <!-- two") == "one" and mainhtml.main_text("<svg>one") == "one"
    assert mainhtml.main_text("<P CLASS=x A=1 A=2>&Eacute;t&#233; &lt;b&gt;&nbsp;x</P>") == "Été <b> x"
    assert mainhtml.main_text("<div>" * 3000 + "deep<p>er" + "</div>" * 3000) == "deep er"


@pytest.mark.parametrize("unit", ["<a '", '<a b="', "<", "</", "<!--", "<svg>", "<script", "<p><i>", "<div class=x ", "<i>", "<b><div>", "&amp", "<title>", "<ul><li>x", "</b>", "<a href='x"])
def test_the_scan_is_linear(unit):
    def seconds(n):
        began = time.process_time()
        mainhtml.main_text(unit * n)
        return time.process_time() - began

    seconds(1000)
    small, large = min(seconds(4000) for _ in range(3)), min(seconds(32000) for _ in range(2))
    assert large < 24 * small + 0.1


def random_tree(rng, depth=0):
    tag = rng.choice(["div", "section", "p", "p", "span", "ul", "li", "a", "blockquote"])
    inner = "".join(random_tree(rng, depth + 1) if depth < 4 and rng.random() < 0.6 else " ".join(rng.choice(["word", "words,", "x"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 4)))
    return f"<{tag}>{inner}</{tag}>"


def reckoned(node, points):
    """Plain recursion: adds every paragraph's points to its ancestors; returns the block texts below a node and characters in links."""
    own = " ".join("".join(p for p in node.parts if isinstance(p, str)).split())
    inner = [p for p in node.parts if isinstance(p, mainhtml.Node) and not p.outside]
    chars, links = len(own), 0
    for part in inner:
        c, l = reckoned(part, points)
        chars, links = chars + c, links + l
    if node.tag == "a":
        links = chars
    container = node.tag in mainhtml.CONTAINERS
    if node.tag in ("p", "pre", "td", "blockquote", "li") or (container and own):

        def line(n):
            return "".join(p if isinstance(p, str) else " " if p.tag in mainhtml.BLOCK else line(p) for p in n.parts)

        said = " ".join(line(node).split())
        if said:
            worth = (1 + said.count(",") + min(len(said) / 100, 10)) * (0.25 if node.tag == "li" else 1) * (1 - (links / chars if chars else 0))
            above, share = (node if container and own else node.parent), 1.0
            while above is not None and share >= 0.25:
                if above.tag in mainhtml.CONTAINERS:
                    points[id(above)] = points.get(id(above), mainhtml.FIRST_POINTS.get(above.tag, 0.0)) + worth * share
                    share /= 2
                above = above.parent
    return chars, links


def test_scores_equal_a_plain_reckoning():
    rng = random.Random(12)
    for _ in range(300):
        html = "".join(random_tree(rng) for _ in range(rng.randint(1, 3)))
        root, points = mainhtml.parse(html), {}
        mainhtml.settle_marks(root)
        scored = mainhtml._score(root)
        reckoned(root, points)
        assert {id(n) for n in scored} == set(points)
        assert all(n.points == pytest.approx(points[id(n)]) for n in scored)


def test_the_query_takes_every_page(spark, tmp_path):
    from tidemark.llm import queries

    pages = [(1, "u", f"<article>{ARTICLE}</article>"), (1, "u", f"<article>{ARTICLE}</article>"), (None, None, None), (3, "v", ""), (4, None, "<p>" + "a, b. " * 200_000)]
    spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, n_chars int").write.parquet(f"{tmp_path}/pages.parquet")
    out = queries.op7_main_text(spark, str(tmp_path))
    assert out.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    found = sorted((str(r["page_id"]), r["text"] or "", r["n_chars"]) for r in out.collect())
    assert found == sorted((str(p), t, len(t)) for p, t in [(1, TEXT), (1, TEXT), (None, ""), (3, ""), (4, ("a, b. " * 200_000).strip())])
