import math
import random

import pytest
from conftest import prose

from logloom.llm import extract, html_tree
from logloom.plans.scratch import saved

PAGE = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows, extra=False):
        if not extra:
            return spark.createDataFrame(rows, PAGE)
        clash = ["host", "layout", "page", "nodes", "texts", "blocks", "text", "n", "out"]
        return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], f"{PAGE}, " + ", ".join(f"{name} string" for name in clash))

    return make


def texts_of(html):
    return [text for _, text in html_tree.page_parts(html)[2]]


def extracted(df):
    return {r["page_id"]: r["text"] for r in extract.extract_text(df).collect()}


@pytest.mark.parametrize("html, want", [
    ("<p>one<p>two</p>three", ["one", "two", "three"]),
    ("<p><b>one<br>two<p>three", ["one two", "three"]),
    ("<p>a<b>b</b>c <i>d</i>\n\t e&nbsp;&amp;&eacute;&#233;&lt;b&gt;</p>", ["abc d e &éé<b>"]),
    ("<ul><li>one<li>two<ul><li>in</ul>after</ul>", ["one", "two", "in", "after"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>4", ["1", "2", "3", "4"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
    ("x<script>var t='<p>no</p>';</script>y<style>p{}</style><!-- <p>no</p> -->z", ["xyz"]),
    ("<SCRIPT>no</SCRIPT ><title>no</title>yes<script>never closed <p>no", ["yes"]),
    ("1 < 2 and 3 > 2 <", ["1 < 2 and 3 > 2 <"]),
    ("<p title=\"a>b\" x='<p>'>in</p><p class=it's>it's</p><p title=\"open>text</p>", ["in", "it's", "text"]),
    ("<a <b>bold</b> <p", ["bold"]),
    ("<div>a</span></div></p>b</div></div><p/>c", ["a", "b", "c"]),
    ("<p>buy <button>now</button> or <span class='ad-label'>advert <span>x</span> y</span>later</p>", ["buy or later"]),
    ("<div><p>one</div>two", ["one", "two"]),
    ("<div><td>a<table><tr><td>b</div>c</table>d", ["a", "bc", "d"]),
    ("<![CDATA[raw <p>]]> x <?php echo 1 ?> <!doctype html>", ["raw <p> x"]),
    ("", []), (None, []), ("  \n ", []), ("<!-- open", []), ("<div></div><p> </p>", []), ("plain", ["plain"]),
])
def test_texts_of_markup(html, want):
    assert texts_of(html) == want


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "in" + "</div>" * 20_000 + "out"
    nodes = html_tree.page_parts(deep)[1]
    assert texts_of(deep) == ["in", "out"] and max(len(node[4]) for node in nodes.values()) <= html_tree.MOST_DEPTH + 1
    many = "".join(f"<p>{i}" for i in range(50_000))
    assert texts_of(many) == [str(i) for i in range(50_000)] and len(html_tree.page_parts(many)[1]) == 3
    for broken in ("<a " * 50_000, "<p title=\"" * 20_000, "<" * 100_000, "&" * 100_000, "<!--" * 50_000, "</" * 50_000, "<p x='" * 20_000):
        html_tree.page_parts(broken)


CHROME = """<html><head><title>t</title></head><body class="has-sidebar"><header class="site"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="sidebar widget">Latest</div>
<main><article><header><h1>{title}</h1><p class="byline">By A</p></header><p>{text}</p><aside>Also read</aside><form><input><label>Mail</label></form>
<div class="share-buttons">Share</div><blockquote>{title} quoted</blockquote><footer>Tags</footer></article></main>
<section id="comments"><article><p>First!</p></article></section><div class="adBanner">Buy</div><div style="display: none">hidden</div><footer>&copy; 2024</footer>"""


def test_declared_parts_of_a_single_page(pages):
    got = extracted(pages([(1, "https://a.example/x", CHROME.format(title="Title &amp; more", text="Body <b>text</b>."))]))
    assert got == {1: "Title & more\nBy A\nBody text.\nTitle & more quoted"}


def plain_site(host, n, first=0, kinds=1):
    """Pages without any telling names: the same menu, notice and end on each, an article of its own on each."""
    rows = []
    for i in range(n):
        paragraphs = "".join(f"<p>{prose(first + 100 * i + k, 12)}</p>" for k in range(1 + i % 4))
        menu = "".join(f"<div><b>{word}</b></div>" for word in ("Start", "News", "Shop"))
        html = f"<body><div class=x{i}><div>{menu}</div><div><h1>{prose(first + i, 4)}</h1>{paragraphs}</div><div>Accept all &mdash; ok {i % kinds}</div></div><div>imprint of {host}</div>"
        want = "\n".join([prose(first + i, 4)] + [prose(first + 100 * i + k, 12) for k in range(1 + i % 4)])
        rows.append(((first + i, f"http://u@{host.upper()}:80/{i}", html), want))
    return rows


def test_what_a_site_repeats_goes_without_any_names(pages):
    sites = plain_site("a.example", 40) + plain_site("b.example", 12, 5000)
    got = extracted(pages([row for row, _ in sites]))
    assert got == {row[0]: want for row, want in sites}


def test_repeated_rows_are_no_evidence(pages):
    row, want = plain_site("a.example", 1)[0]
    everything = "Start\nNews\nShop\n" + want + "\nAccept all — ok 0\nimprint of a.example"
    got = extract.extract_text(pages([row] * 50)).collect()
    assert len(got) == 50 and {r["text"] for r in got} == {everything}


def test_copies_in_a_site_stay(pages):
    site = plain_site("a.example", 30)
    copies = [((9000 + i, "http://a.example/copy", f"{site[3][0][2]}<!-- {i} -->"), site[3][1]) for i in range(200)]
    near = [((9500 + i, "http://a.example/near", site[7][0][2].replace("</h1>", f" {i}</h1>")), site[7][1].replace("\n", f" {i}\n", 1)) for i in range(15)]
    got = extracted(pages([row for row, _ in site + copies + near]))
    assert got == {row[0]: want for row, want in site + copies + near}


def slow_tree(rows, prior=extract.PRIOR_PAGES, damping=extract.DAMPING, least=extract.LEAST_IMPORTANCE):
    """Importance of every node by recursion over the merged tree of one site."""
    seen = {}
    for _, _, html in rows:
        _, nodes, texts = html_tree.page_parts(html)
        seen[tuple(texts)] = (nodes, texts)
    merged, count, said = {}, {}, {}
    for nodes, texts in seen.values():
        merged.update(nodes)
        for key in nodes:
            count[key] = count.get(key, 0) + 1
        for key, text in set(texts):
            said.setdefault(key, {}).setdefault(text, 0)
            said[key][text] += 1
    below = {}
    for key, (style, _, _, _, path) in merged.items():
        if style is not None:
            below.setdefault(path[1], {}).setdefault(style, []).append(key)

    def importance(key):
        _, _, role, is_text, _ = merged[key]
        m = count[key]
        if is_text:
            entropies = [math.log(k) / math.log(m) for k in said[key].values()] if m > 1 else [0]
            held = (m * (1 - min(1, sum(entropies) / len(entropies))) + prior) / (m + prior)
            return {html_tree.ASIDE: extract.ASIDE_WEIGHT * held, html_tree.MAIN: max(held, least)}.get(role, held)
        styles = below[key]
        pages = {style: max(count[k] for k in keys) for style, keys in styles.items()}
        total = sum(pages.values())
        own = min(1, -sum(k / total * math.log(k / total) for k in pages.values()) / math.log(m)) if m > 1 else 1
        down = sum(pages[style] / total * sum(map(importance, keys)) / len(keys) for style, keys in styles.items())
        d = damping ** len(styles)
        return (1 - d) * own + d * down

    def most(key):
        return max([importance(key)] + [most(k) for keys in below.get(key, {}).values() for k in keys])

    return {key: (count[key], importance(key), most(key) < least) for key in merged}


def random_site(seed):
    rng = random.Random(seed)

    def element(depth):
        tag = rng.choice(["div", "p", "ul", "section", "article", "nav", "h2", "div class=menu"])
        inside = "".join(element(depth + 1) if depth < 4 and rng.random() < 0.6 else rng.choice(["same ", "x", str(rng.randint(0, 9))]) for _ in range(rng.randint(0, 3)))
        return f"<{tag}>{inside}</{tag.split()[0]}>"

    shapes = ["".join(element(0) for _ in range(3)) for _ in range(4)]
    return [(i, "http://h/", rng.choice(shapes).replace("same", f"same {rng.choice('ab')}") + f"<p>{i % 7}</p>") for i in range(25)]


@pytest.mark.parametrize("seed", range(3))
def test_tree_against_recursion(pages, seed):
    rows = random_site(seed)
    got = extract.style_tree(saved(extract.site_parts(pages(rows)), "parts")).collect()
    want = slow_tree(rows)
    assert {r["node"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, importance, noisy = want[r["node"]]
        assert r["n_pages"] == n and r["importance"] == pytest.approx(importance, abs=1e-9)
        assert r["noisy"] == noisy or abs(importance - extract.LEAST_IMPORTANCE) < 1e-9
    quiet = {k for k, v in want.items() if v[2]}
    texts = extract.extract_text(pages(rows)).collect()
    assert {r["page_id"]: r["text"] for r in texts} == {i: "\n".join(t for k, t in html_tree.page_parts(h)[2] if k not in quiet) for i, _, h in rows}


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(pages, extra):
    rows = [(None, None, None), (None, None, "<p>a</p>"), (1, "", ""), (1, "no url", "<p>b"), (2, "http://x/", None), (3, "http://x/", "<nav>menu</nav>"),
            (4, "http://x/", "<p>é漢😀</p>"), (4, "http://x/", "<p>é漢😀</p>"), (5, "http://[::1]/", "<article></article>")]
    got = extract.extract_text(pages(rows, extra)).collect()
    assert sorted(((r["page_id"], r["url"], r["text"], r["n_chars"], r["n_blocks"], r["n_removed"]) for r in got), key=repr) == sorted(
        [(None, None, "", 0, 0, 0), (None, None, "a", 1, 1, 0), (1, "", "", 0, 0, 0), (1, "no url", "b", 1, 1, 0), (2, "http://x/", "", 0, 0, 0),
         (3, "http://x/", "", 0, 1, 1), (4, "http://x/", "é漢😀", 3, 1, 0), (4, "http://x/", "é漢😀", 3, 1, 0), (5, "http://[::1]/", "", 0, 0, 0)], key=repr)


def test_nothing(pages):
    assert extract.extract_text(pages([])).collect() == []
