"""Main texts of pages whose text is known, wrappers by hand, and reading of broken markup."""

import html
import json
import random

import pytest

from gatelog.llm import html_wrappers as wrappers
from gatelog.llm.html_blocks import label, read

SCHEMA = "page_id long, url string, html string, text string, host string, wrapper string, own string, body string"


def texts(spark, rows, partitions=3):
    clash = ("text", "host", "wrapper", "own", "body")
    df = wrappers.main_texts(spark.createDataFrame([(*r, *clash) for r in rows], SCHEMA).repartition(partitions))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    found = df.collect()
    assert all(r.n_chars == len(r.text) for r in found)
    return found


def expression(item):
    """A wrapper as text, as in regular expressions."""
    if item[0] == "#":
        own = "#" if item[5] is None else "c"
    elif item[0] == "(":
        own = "(" + "".join(map(expression, item[2])) + ")"
    else:
        own = f"<{item[0][1:]}>" + "".join(map(expression, item[2])) + "</>"
    return own if not item[1] else f"({own})" + ["", "?", "+", "*"][item[1]]


def wrapper(*pages):
    items = wrappers.stream(read(pages[0]))
    for page in pages[1:]:
        items = wrappers.align(items, wrappers.stream(read(page)))
    return "".join(map(expression, items))


def test_wrappers():
    """Text mismatches become slots, tag mismatches repeated or optional parts."""
    one = "<h2>Books of</h2><div>A</div><ul><li>x</li><li>y</li></ul>"
    two = "<h2>Books of</h2><div>B</div><center>img</center><ul><li>x</li><li>y</li><li>z</li></ul>"
    assert wrapper(one) == "<h2>c</><div>c</><ul>(<li>#</>)+</>"
    assert wrapper(one, two) == wrapper(two, one) == "<h2>c</><div>#</>(<center>c</>)?<ul>(<li>#</>)+</>"
    assert wrapper("<p>a", "<p>a<p>b<p>c") == "(<p>#</>)+"
    assert wrapper("<h3>a</h3><p>b</p><h3>c</h3><p>d</p>") == "((<h3>#</><p>#</>))+"
    assert wrapper("<h3>a</h3><p>b</p>", "<h3>a</h3><p>b</p><h3>c</h3><p>d</p><p>e</p>").startswith("((<h3>")
    assert wrapper("<div><i>t</i></div>", "") == "(<div>c</>)?"
    assert wrapper("") == ""


def test_wrappers_stay_small():
    """Repeats fold, random classes are left out where a level has very many elements, deep nesting ends."""
    assert len(json.dumps(wrappers.stream(read("<p>word" * 20_000)))) < 200
    many = "".join(f"<div class='x{''.join(random.Random(i).choices('abcdefgh', k=9))}'>t{i}</div>" for i in range(3000))
    assert len(wrappers.stream(read(many))) == 1
    deep = read("<div>" * 50_000 + "end" + "</div>" * 50_000 + "<p>after")
    assert len(json.dumps(wrappers.stream(deep))) < 4000
    assert wrappers.Wrapper(wrappers.stream(deep)).main_text(deep) == ["end", "after"]


def blocks(page):
    tree = read(page)
    return wrappers.Wrapper(wrappers.stream(tree)).main_text(tree)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        (" \n\t ", []),
        ("plain  text\n only", ["plain text only"]),
        ("<p>a<p>b</p>c<div>d", ["a", "b", "c", "d"]),
        ("<p>one <b>two</b> <i>th</i>ree<br>four</p>", ["one two three four"]),
        ("<p>&lt;b&gt; &amp;lt; &eacute;&#233;&#xe9; &nbsp; &unknown; AT&T &amp", ["<b> &lt; ééé &unknown; AT&T &"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
        ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", ["a", "b", "c", "d"]),
        ("<title>t</title><script>if (a < b) '</p>'</script><style>p{}</style><p>x</p><noscript>n</noscript>", ["x"]),
        ("<p>x</p><script>never closed <p>y</p>", ["x"]),
        ("<p>x<!-- <p>y</p> --> z</p><!-- open <p>w", ["x z"]),
        ("<p>1 < 2 and 3<4</p><p title='a > b'>c</p><p class=\"open>d</p>", ["1 < 2 and 3<4", "c", "d"]),
        ("<p>a</p><p", ["a"]),
        ("</p></div>a</article>b", ["a", "b"]),
        ("<div><article>a</div>b</article>c", ["a"]),
        ("<form id='page'><article>a<form>f</form></article></form>", ["a"]),
        ("<header>h</header><article><header><h1>t</h1></header>a<footer>f</footer></article>", ["t", "a"]),
        ("<article>a</article><div class='comments'><article>reader</article></div>", ["a"]),
        ("<article class='post has-comments'>a<section id='comments'>r</section></article><article class='comment'>r</article>", ["a"]),
        ("<main><h1>t</h1><p>a</p><aside>s</aside><div class='cookie-notice'>n</div></main><p>out</p>", ["t", "a"]),
        ("<div class='post-content'><p>a</p><div class='share-buttons'>s</div></div><div>out</div>", ["a"]),
        ("<div class='has-sidebar'><div class='entry'>a</div></div><div class='sidebar'><div class='content'>s</div></div>", ["a"]),
        ("<article></article><div>a</div>", ["a"]),
        ("<p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p><p>d</p>", ["d"]),
        ("<span class='ad'>x <span>y</span> z</span>a", ["a"]),
        ("<ul><li><a>m1</a><li><a>m2</a><li><a>m3</a></ul><p>text with a <a>link</a></p>", ["text with a link"]),
    ],
)
def test_blocks(page, want):
    assert blocks(page) == want


def test_labels():
    assert label("div", ' class="post-12 Wide" id=main-3') == "3div main-# post-# Wide"
    assert label("p", "") == " p" and label("nav", "")[0] == "-" and label("div", " class='navBar'")[0] == "~"
    assert label("div", " role=article")[0] == "1" and label("div", " class=download")[0] == " "


def pages_of(style, seed, n, same=()):
    """Pages of a host with known main texts."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefghijklmno", k=chance.randrange(2, 9)))
    line = lambda k: " ".join(word() for _ in range(k))
    tagline, notice, rows = line(6), line(8), []
    for i in range(n):
        title, body = line(5), [line(chance.randrange(3, 40)) + " & <co>" for _ in range(chance.randrange(1, 9))]
        if i in same:
            title, body = "one title", ["the same text here", "and there"]
        shown = "".join(f"<p>{html.escape(b)}</p>" if chance.random() < 0.7 else f"<p>{html.escape(b)}\n" for b in body)
        menu = "".join(f"<li><a href=/{k}>{line(2)}</a></li>" for k in range(chance.randrange(3, 7)))
        comments = "".join(f"<div class=comment><p>{line(9)}</p></div>" for _ in range(chance.randrange(3)))
        extra = f"<div>{notice}</div>" if i % 2 else ""
        if style == "article":
            page = (
                f"<html><head><title>{title}</title></head><body><header><p>{tagline}</p></header><nav><ul>{menu}</ul></nav><div class=ad>{line(7)}</div>"
                f"<article><h1>{title}</h1>{shown}</article><section id=comments>{comments}</section><aside>{line(9)}</aside><footer>{line(5)}</footer>"
            )
        else:  # nothing but the host's other pages tells what is the template's
            page = (
                f"<body><div><div>{tagline}</div><ul>{menu}</ul></div>{extra}<table><tr><td><h2>{title}</h2>{shown}</td></tr></table>"
                f"<center>{tagline} again</center><div class='comment-list'>{comments}</div></body>"
            )
        rows.append((f"<!-- {i} -->" + page, [title, *body]))
    return rows


def test_known_pages(spark):
    rows, want = [], {}
    for number, (style, n, same) in enumerate([("article", 40, (3, 4, 5, 6)), ("article", 1, ()), ("plain", 40, (1, 2)), ("plain", 25, ())]):
        for i, (page, body) in enumerate(pages_of(style, number, n, same)):
            key = number * 100 + i
            rows.append((key, f"https://Host{number}.example.org:80/{i}", page))
            want[key] = "\n".join(body)
    got = texts(spark, rows)
    assert {r.page_id: r.text for r in got} == want and len(got) == len(rows)
    rows += rows[:60]
    assert {r.page_id: r.text for r in texts(spark, rows, partitions=7)} == want


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 2)
    long = "<article>" + "<p>word &amp; more</p>" * 100_000 + "</article>"
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (2, "no url", None), (None, "", ""), (3, "http://h/", long), (4, "http://h/2", "<p>b")]
    got = sorted(((r.page_id, r.url, r.text) for r in texts(spark, rows)), key=repr)
    want = [(1, None, "a"), (1, None, "a"), (2, "no url", ""), (None, "", ""), (3, "http://h/", "\n".join(["word & more"] * 100_000)), (4, "http://h/2", "b")]
    assert got == sorted(want, key=repr)
    assert texts(spark, []) == []


def test_time_is_linear():
    import time

    def seconds(page):
        start = time.perf_counter()
        tree = read(page)
        wrappers.Wrapper(wrappers.stream(tree)).main_text(tree)
        return time.perf_counter() - start

    for unit in ('<a "', "<p title=\"", "<div><p>x", "</x>", "<li>x", "<title>", "<!-", "&amp", "<td><div>", "<div class=a><p>t</p></div><span>", "<tr><td>", "< "):
        assert seconds(unit * 40_000) < 20 * max(seconds(unit * 4_000), 0.02), unit
