import re

import duckdb
import pytest

from biasloom.llm import html_extract
from biasloom.llm.common import Scratch
from biasloom.llm.html_extract import Page, _hash, extract, main_text

CASES = [
    ("", ""),
    ("plain & simple", "plain & simple"),
    ("<p>a<p>b<br>c", "a\n\nb c"),
    ("<body><nav>menu</nav><article><h1>T&amp;t</h1><p> x\n <b>y</b>z </p></article>"
     "<footer>&copy; f</footer></body>", "T&t\n\nx yz"),
    ("<div class='sidebar'>s</div><div>one<p>two</p>three</div>", "one\n\ntwo\n\nthree"),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<main><header><h1>Title</h1></header><p>body</p><aside>x</aside>"
     "<section class='post-comments'><p>first!</p></section></main><p>outside</p>",
     "Title\n\nbody"),
    ("<p>1 < 2 &lt;3 &#233;&nbsp;&eacute;</p>", "1 < 2 <3 é é"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<div class=adBox>buy</div><div id='cookie-notice'>ok?</div><form>f<p>g</form><p>h", "h"),
    ("<p hidden>no</p><div style='display:none'>no</div><a title='x>y' href=\"q\">l</a>", "l"),
    ("<head><title>t</title><p>no head end", "no head end"),
    ("<article><p>a</article><article class=comment><p>c</article><article><p>b</article>",
     "a\n\nb"),
    ("<p>a</div></p></b>b", "a\n\nb"),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_extract(page, want):
    assert extract(page) == want


def site(i, host):
    links = "".join(f"<li><a href=/{j}>topic {j * i}</a></li>" for j in range(i % 4 + 2))
    return (
        f"<html><body><div><ul>{links}</ul></div><div><span>Welcome to {host}</span></div>"
        f"<div><h1>Story {i}</h1><p>Words of story {i}, &quot;told&quot; here.</p>"
        f"<p>All rights of the stories stay with {host}.</p></div></body></html>"
    )


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"h{i % 2}", site(i, f"h{i % 2}"), "x") for i in range(40)]
    rows += [(100, "alone", site(3, "alone"), "x"), (101, None, "<p>no host", "x")]
    rows += [(102, "h0", None, "x"), (103, "h1", "", "x"), (None, "h1", "<p>own", "x")]
    rows += [rows[0], (104, "same", site(1, "same"), "x")]
    rows += [(200 + i, "same", site(1, "same"), "x") for i in range(9)]
    return spark.createDataFrame(rows, "page_id long, host string, html string, text string")


def test_template_of_a_host(spark, pages):
    got = main_text(pages, Scratch(spark, "test")).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == pages.count()
    for i in range(40):
        assert by[i] == f'Story {i}\n\nWords of story {i}, "told" here.'
    assert "All rights" in by[100] and "Welcome" in by[100]
    assert (by[101], by[102], by[103], by[None]) == ("no host", "", "", "own")
    assert "Story 1" in by[204]
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty(spark, pages):
    assert main_text(pages.limit(0), Scratch(spark, "test")).count() == 0


def layout(i):
    """One of two layouts of a host, each with a fixed text and a link slot of its own."""
    links = "".join(f"<li><a href=/{j}>topic {j * i}</a></li>" for j in range(i % 4 + 2))
    story = f"<h1>Story {i}</h1><p>Words of story {i}, told here.</p>"
    if i % 2:
        return (
            f"<body><div><ul>{links}</ul></div><div><span>Welcome to the one</span></div>"
            f"<div>{story}<p>All rights stay with the one.</p></div></body>"
        )
    return (
        f"<body><table><tr><td>Room of the other</td></tr></table><section>{story}</section>"
        f"<section><dl><dt>Read on in the other</dt></dl><ol>{links}</ol></section></body>"
    )


def test_two_layouts_of_a_host(spark):
    rows = [(i, "h", layout(i)) for i in range(40)]
    rows += [(100 + i, "h", rows[i][2]) for i in range(2)]
    # Pages that share their content are no layout.
    shared = "".join(f"<p>Shared line {k} of a common story.</p>" for k in range(9))
    rows += [
        (200 + i, "h", f"<body><div><h1>Common</h1>{shared}<p>Line {i}.</p></div></body>")
        for i in range(6)
    ]
    df = spark.createDataFrame(rows, "page_id long, host string, html string")
    got = {r.page_id: r.text for r in main_text(df.repartition(3), Scratch(spark, "test")).collect()}
    for i in [*range(40), 100, 101]:
        assert got[i] == f"Story {i % 100}\n\nWords of story {i % 100}, told here."
    for i in range(6):
        assert got[200 + i].startswith("Common\n\nShared line 0") and f"Line {i}." in got[200 + i]


#: Names that say less than they seem to, and parts that are none beside the article.
MISLEADING = [
    ('<article class="post category-search"><p>Body of it</p></article>', "Body of it"),
    ('<div class="content has-sidebar"><p>Body</p></div>', "Body"),
    ('<div id="page" class="no-header"><p>Body</p></div>', "Body"),
    ('<div id="page" class="search"><p>Body</p></div><p>x</p>', "Body\n\nx"),
    ('<article><p>All about it.</p><section class="related-work"><p>Others</p></section>'
     '<p class="comment-free">Free</p></article>', "All about it.\n\nOthers\n\nFree"),
    ('<article>Teaser</article><div class="entry"><p>The real text of it</p></div>',
     "Teaser\n\nThe real text of it"),
    ("<article><p>a <math><mi>x</mi></math> b</p><svg><text>c</text></svg>"
     "<noscript>d</noscript> <label>e</label></article>", "a x b\n\ncd e"),
    ("<form><p>All of a page may be in a form</p></form><p>b</p>",
     "All of a page may be in a form\n\nb"),
]


@pytest.mark.parametrize(("page", "want"), MISLEADING)
def test_no_container_is_lost_by_a_word(page, want):
    assert " ".join(extract(page).split()) == " ".join(want.split())


def test_unmatched_tags_take_linear_time():
    import time

    began = time.perf_counter()
    assert extract("<b></i>" * 64_000 + "<p>x" * 20_000).startswith("x\n\nx")
    assert extract("<div>" * 20_000 + "deep") == "deep"
    assert time.perf_counter() - began < 20


def neutral(page):
    """A page whose tags and names say nothing."""
    page = re.sub(r"(</?)(?:nav|article|footer|header|aside|main|section)\b", r"\1div", page)
    return re.sub(r"""\s(?:class|id|role)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", "", page)


@pytest.fixture(scope="module")
def given():
    rows = duckdb.sql("SELECT page_id, url, html FROM '/root/testdata/sf0.1/pages.parquet'").fetchall()
    return [(i, re.sub(r"^[^:]*://([^/?#]*).*$", r"\1", u or ""), h or "") for i, u, h in rows]


def test_the_template_finds_the_article_without_telling_tags(spark, given):
    """Of the given pages with neutral tags and no names, nine of ten give their text."""
    want = {i: extract(page) for i, _, page in given}
    rows = [(i, host, neutral(page)) for i, host, page in given]
    df = spark.createDataFrame(rows, "page_id long, host string, html string").repartition(4)
    got = {r.page_id: r.text for r in main_text(df, Scratch(spark, "test")).collect()}
    alone = sum(extract(page) == want[i] for i, _, page in rows)
    right = sum(got[i] == want[i] for i in want)
    assert right >= 0.9 * len(want) and alone < 0.1 * len(want), (right, alone, len(want))


def test_telling_tags_and_the_template_agree(spark, given):
    df = spark.createDataFrame(given, "page_id long, host string, html string")
    got = {r.page_id: r.text for r in main_text(df, Scratch(spark, "test")).collect()}
    assert sum(got[i] != extract(page) for i, _, page in given) == 0


def plain_template(pages):
    """Fixed texts and menus of one host, from whole occurrence vectors."""
    vectors, above, chars, links = {}, {}, {}, {}
    for at, page in enumerate(pages):
        for path, up in page.elements:
            vectors.setdefault((path, 1), [0] * len(pages))[at] += 1
            above[path, 1] = up
        for b in page.blocks:
            token = (_hash(b.slot, b.text), 0)
            vectors.setdefault(token, [0] * len(pages))[at] += 1
            above[token] = b.slot
            chars[b.slot] = chars.get(b.slot, 0) + len(b.text)
            links[b.slot] = links.get(b.slot, 0) + b.links

    def shape(vector):
        held = [n for n in vector if n]
        # What is always there equally often counts as there once.
        return tuple(int(n > 0) for n in vector) if min(held) == max(held) else ("n", *vector)

    classes = {}
    for token, vector in vectors.items():
        if sum(n > 0 for n in vector) >= 5:
            classes.setdefault(shape(vector), set()).add(token)
    kind = {}
    for vector, tokens in classes.items():
        n = sum(x > 0 for x in vectors[next(iter(tokens))])
        places = {above[t] for t in tokens}
        if n >= 0.9 * len(pages):
            kind[vector] = 0
        elif len(tokens) >= 2 and any(t[1] for t in tokens):
            kind[vector] = 1
        elif len(tokens) >= 2 and len(places) > 1:
            kind[vector] = 2
    placed = {t: kind[v] for v, ts in classes.items() if v in kind for t in ts}
    known = {t[0] for t in placed if t[1]} | {0}
    often = {t for ts in classes.values() for t in ts}
    slots = {t[0] for t in often if t[1] and above[t] in known}
    known |= slots
    nested = {v for v, ts in classes.items() if v in kind and any(above[t] in known for t in ts)}
    kept = {t for v in nested for t in classes[v]}
    fixed = {t[0]: placed[t] for t in kept if not t[1]}
    menus = {
        s for s in {t[0] for t in kept if t[1]} | slots
        if chars.get(s) and links.get(s, 0) >= 0.7 * chars[s]
    }
    return fixed, menus


@pytest.mark.parametrize("kind", [site, layout])
def test_classes_equal_a_plain_deduction(spark, kind):
    """The template's fixed texts and menus, from classes of whole vectors."""
    pages = [kind(i, "h") if kind is site else kind(i) for i in range(24)]
    rows = [("h", k * 7919 + 1, page) for k, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "host string, mark long, page string")
    parsed = Scratch(spark, "test").keep(html_extract._parsed(df, False), "shapes")
    template = html_extract._template(html_extract.host_tokens(parsed)).collect()
    fixed, menus = plain_template([Page(p) for p in pages])
    assert {r.token: r.kind for r in template if not r.element and r.kind is not None} == fixed
    found = {r.token for r in template if r.element and r.chars and r.links >= 0.7 * r.chars}
    assert found == menus and fixed and menus


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None, None, 1)] + [(1, "h", "<p>a", 2)] * 9 + [(2, None, "<p>b", None)]
    df = spark.createDataFrame(rows, "token long, host string, html string, row long")
    df = df.withColumns({"texts": df.row, "mark": df.row, "he__0": df.row})
    got = main_text(df, Scratch(spark, "test")).collect()
    assert sorted((r.token or 0, r.row or 0, r.text) for r in got) == [
        (0, 1, ""), *[(1, 2, "a")] * 9, (2, 0, "b")
    ]
    long = "<p>" + "word " * 400_000
    big = spark.createDataFrame([(1, "h", long)], "page_id long, host string, html string")
    assert main_text(big, Scratch(spark, "test")).first().n_chars == 5 * 400_000 - 1
