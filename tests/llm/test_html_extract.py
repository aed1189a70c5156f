import json
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabular_lifecycle.llm import html_extract
from tabular_lifecycle.llm.html_extract import Page, Tree, match_trees, merge_trees

PROSE = ["A storm came over the hills & rain fell.", "Nobody saw the old bridge give way in the night.", "By noon the river had reached the mill."]


def article(i, extra=""):
    words = " ".join(f"word{i}x{j}" for j in range(30))
    return f"<h1>Title {i}</h1><p>First {words}.</p>{extra}<p>Second {words}.</p>", f"Title {i} First {words}. Second {words}."


def marked(i):
    body, text = article(i, '<div class="ad-slot">Buy {i}</div><aside>Related {i}</aside><p>Ends <b>bo</b>ld<br>here.')
    text = text.replace(". Second", ". Ends bold here. Second")
    page = (f"<html><head><title>T{i}</title><style>p{{}}</style></head><body class='sidebar-left'><header>Site {i}</header><nav><a href=/>Home {i}</a></nav>"
            f"<div id=cookieNotice>We use cookies {i}</div><main><article class='post category-comments'><header>{body}</header>"
            f"<section class=comments><article>Reader {i} says no</article></section><form>Mail {i}<input></form></article></main>"
            f"<script>if (a < b) document.write('<p>no {i}</p>')</script><footer>&copy; {i}</footer>")
    return page, text


def plain(i):
    """No element says what it is: the wrapper decides."""
    body, text = article(i)
    links = "".join(f"<li><a href=/{i}/{j}>Link {i} {j}</a></li>" for j in range(6))
    page = (f"<body><div class=a1><ul>{links}</ul></div><div class=b{i}><p class=z>Read our terms of use before you go on.</p>{body}</div>"
            f"<div class=c><p>Made {'with care' if i else 'with care'} in our office.</p></div></body>")
    return page, text


def pages():
    rows, want = [], {}
    for host, make, n in (("marked.example", marked, 7), ("plain.example", plain, 12)):
        for i in range(n):
            page, text = make(i)
            rows.append((len(rows), f"https://{host.upper() if i % 2 else host}/p/{i}", page))
            want[len(rows) - 1] = text
    alone = f"<div><p>{PROSE[0].replace('&', '&amp;')}</p><p>{PROSE[1]}<p>{PROSE[2]}</div>"
    copies = "<article><h1>Same</h1><p>Every page of this host is a copy of it.</p></article>"
    odd = [("https://alone.example/", alone, " ".join(PROSE)), (None, "<p>No host &lt;here&gt;", "No host <here>"), ("not a url", "text only", "text only"),
           ("https://alone.example/2", None, ""), (None, None, ""), ("https://e.example", "", ""), ("https://e.example", "<nav>x</nav>", ""),
           ("https://e.example", "<p>a</p><!-- <p>no</p> --><![CDATA[no]]><p>b<!-- open", "a b"), ("https://d.example", "<div>" * 300 + "deep" + "</div>" * 300, "deep"),
           ("https://t.example", "<table><tr><td>1<td>2<tr><td>3</table><ul><li>x<li>y</ul><p hidden>no<p>z", "1 2 3 x y z"),
           ("https://i.example", "<p>a<span style='display: none'>no</span>b <i>c</i>d</p>", "ab cd"), ("https://q.example", "<p title=\"a > b\">ok</p><p title='x>y", "ok y")]
    odd += [("https://copies.example", copies, "Same Every page of this host is a copy of it.")] * 8
    for url, page, text in odd:
        rows.append((len(rows), url, page))
        want[len(rows) - 1] = text
    return rows + [rows[0], (None, "https://alone.example/", alone)], want


def test_extract(spark):
    rows, want = pages()
    got = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        # Names the operator uses itself stand beside the named columns.
        df = spark.createDataFrame([(*r, 1, "s", "t") for r in rows], "page_id long, url string, html string, slot int, host string, text string").repartition(seed + 2)
        out = html_extract.extract(df)
        assert sorted(out.columns) == sorted(["page_id", "url", "slot", "host", "text"])
        got.append(Counter((r.page_id, r.url, r.text, r.slot, r.host) for r in out.collect()))
    assert got[0] == got[1] and sum(got[0].values()) == len(rows)
    for page_id, url, text, *_ in got[0]:
        assert text == (want[page_id] if page_id is not None else " ".join(PROSE)), (page_id, url)


def test_empty_table(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_template_needs_five_different_pages():
    few = html_extract.choose('[[-1,"html"],[0,"h2"],[0,"p"]]', {1: (10, 0, True), 2: (50, 0, False)})
    assert few[2] == [2] and few[0] == []


@pytest.mark.parametrize("inside", ["<nav>x</nav> y</nav>", "y<script>'</nav>'</script></nav>", "y<!-- </nav> --></nav>", "y</nav x=1>", "y"])
def test_left_out_elements_end_where_they_end(inside):
    page = Page(f"<p>a</p><nav class=k>{inside}" + ("<p>b" if "</nav" in inside else ""))
    assert [b[1] for b in page.blocks] == (["a", "b"] if "</nav" in inside else ["a"])


def test_many_kinds_and_long_pages():
    page = Page("".join(f"<p class='k{'abcdefghij'[i % 10] * (i // 10 + 1)}'>t{i}</p>" for i in range(3000)))
    assert len(page.slots) <= html_extract.MAX_SIBLINGS + 3
    assert [b[1] for b in page.blocks] == [f"t{i}" for i in range(3000)]
    assert Page("<b>" * 50000 + "x").blocks == [(0, "x", 0)]
    assert len(Page("<p>" + "word " * 200000).blocks[0][1]) == 5 * 200000 - 1


def test_character_references_and_links():
    page = Page("<p>&lt;p&gt; &#65;&#x42; &nbsp; &eacute; &unknown; AT&T <a href=x>li nk</a></p>")
    assert page.blocks == [(1, "<p> AB é &unknown; AT&T li nk", 5)]


def trees(depth):
    label = st.sampled_from(["p", "div", "div.a", "div.b"])
    return st.recursive(label.map(lambda x: (x, ())), lambda t: st.tuples(label, st.lists(t, max_size=3).map(tuple)), max_leaves=6)


def flat(tree):
    out, waiting = [], [(tree, -1)]
    while waiting:
        (label, children), parent = waiting.pop()
        out.append((parent, label))
        waiting.extend((c, len(out) - 1) for c in reversed(children))
    return out


def size(tree):
    return 1 + sum(map(size, tree[1]))


def brute(a, b):
    """Best score over all order-keeping mappings, by plain recursion over the children."""
    if a[0].split(".")[0] != b[0].split(".")[0]:
        return 0

    def forest(x, y):
        if not x or not y:
            return 0
        return max(forest(x[1:], y), forest(x, y[1:]), brute(x[0], y[0]) + forest(x[1:], y[1:]))

    held = forest(a[1], b[1])
    if a[0] != b[0] and (not held or 4 * held < min(size(a), size(b)) - 1):
        return 0
    return held + (2 if a[0] == b[0] else 1)


@settings(max_examples=200, deadline=None)
@given(trees(3), trees(3))
def test_simple_tree_matching_equals_brute_force(a, b):
    a, b = ("html", (a,)), ("html", (b,))
    left, right = Tree(flat(a)), Tree(flat(b))
    pairs = match_trees(left, right)
    score = sum(2 if left.labels[x] == right.labels[y] else 1 for y, x in pairs.items())
    assert score == brute(a, b)
    assert len(set(pairs.values())) == len(pairs)


@settings(max_examples=100, deadline=None)
@given(st.lists(trees(3), min_size=1, max_size=4))
def test_a_wrapper_holds_every_tree(made):
    shapes = [json.dumps(flat(("html", (t,)))) for t in made]
    wrapper, maps = merge_trees(shapes)
    nodes = json.loads(wrapper)
    for shape, to in zip(shapes, maps):
        for i, (parent, label) in enumerate(json.loads(shape)):
            assert nodes[to[i]][1].split(".")[0] == label.split(".")[0]
            assert nodes[to[i]][0] == (to[parent] if parent >= 0 else -1)


def test_groups_of_trees_meet_until_one_wrapper(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "TREES_AT_ONCE", 2)
    shapes = [("h", json.dumps([[-1, "html"], [0, f"div.k{chr(97 + i)}"], [0, "p"]])) for i in range(7)] + [("g", json.dumps([[-1, "html"]]))]
    wrappers, maps = html_extract._align(spark.createDataFrame(shapes, "host string, shape string"))
    assert wrappers.groupBy("host").count().where("count > 1").count() == 0
    by_host = {r.host: json.loads(r.tree) for r in wrappers.collect()}
    for r in maps.collect():
        assert [by_host[r.host][i][1].split(".")[0] for i in r.map] == [n[1].split(".")[0] for n in json.loads(r.shape)]


@pytest.mark.parametrize("url, host", [("HTTP://User@A.Example.:80/x", "a.example"), ("//b.example?x", "b.example"), ("c.example/x", ""), (None, "")])
def test_host(url, host):
    assert html_extract.host_of(url) == host
