"""Main-text extraction."""

import time
from collections import Counter
from itertools import groupby

import numpy as np
import pytest

from corpusmill.llm import html


def test_article_blocks():
    page = html.parse(
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>Home<li>About</ul></nav>"
        "<div class='ad'>Buy &amp; go</div><article><h1>One &lt;two&gt;</h1><p><b>a  b\n c<br>d<p>e&nbsp;f<!-- x --><div class='comments'>no</div>"
        "<p>last</article><footer>&copy; x</footer>"
    )
    assert [t for t, k in zip(page.texts, page.kinds) if k == html.TEXT] == ["One <two>", "a b c d", "e f", "last"]
    assert [t for t, k in zip(page.texts, page.kinds) if k == html.PART] == ["Home", "About", "Buy & go", "no", "© x"]


def test_repeated_runs_are_removed(spark):
    def page(i):
        return f"<body><div>The same words at the top of every page here</div><div>Own words number {i} of page {i} and {i * 7}</div><div>Closing words that all pages of it share too</div>"

    rows = [(i, "http://a.example/x", page(i)) for i in range(6)]
    rows += [(10, "http://b.example/x", page(10)), (11, None, None), (12, "u", ""), (13, "http://c.example", "no tags & <b>bold</b> text")]
    rows += [(14, "http://a.example/y", "<article><p>The same words at the top of every page here</p></article>")] * 2
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    for i in range(6):
        assert text[i] == f"Own words number {i} of page {i} and {i * 7}"
    assert text[10].count("\n\n") == 2  # no other page of its host
    assert text[11] == text[12] == "" and text[13] == "no tags & bold text"
    assert text[14] == "The same words at the top of every page here"
    assert all(r.n_chars == len(r.text) for r in got)


def test_suffix_array_equals_brute_force():
    rng = np.random.default_rng(1)
    for sizes in ([40, 1, 30, 25], [60], [5, 5], [1, 1], []):
        streams = [rng.integers(0, 3, n) for n in sizes]
        if len(sizes) > 2:
            streams[2][:20] = streams[0][10:30]
        order, common, page, x = html.suffix_array(streams)
        ends = np.repeat(np.cumsum(sizes), sizes).astype(int) if sizes else []
        suffix = [tuple(x[k : ends[k]].tolist()) for k in range(len(x))]
        assert sorted(order.tolist()) == list(range(len(x)))
        for k in range(1, len(x)):
            a, b = suffix[order[k - 1]], suffix[order[k]]
            same = next((n for n, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
            assert common[k] == same
        for length, least in ((4, 2), (3, 1), (6, 2)):
            where = {}
            for k in range(len(x)):
                if k + length <= ends[k]:
                    where.setdefault(tuple(x[k : k + length].tolist()), set()).add(int(page[k]))
            at, n = html.repeats(streams, length, least)
            assert {tuple(x[k : k + length].tolist()): m for k, m in zip(at.tolist(), n.tolist())} == {w: len(q) for w, q in where.items() if len(q) >= least}


def brute_texts(rows, p):
    """Texts of pages without articles, by counting every run of tokens."""
    parsed = [(html.host_of(u), h, html.parse(h)) for _, u, h in rows]
    hosts = {}
    for host, h, page in {(a, b): (a, b, c) for a, b, c in parsed}.values():
        hosts.setdefault(host, []).append(html.stream(page)[0])
    out = []
    for host, _, page in parsed:
        seen = Counter(w for t in hosts[host] for w in {tuple(t[k : k + p.length]) for k in range(len(t) - p.length + 1)})
        tokens, owner = html.stream(page)
        gone = {j for k in range(len(tokens) - p.length + 1) if len(hosts[host]) > 1 and seen[tuple(tokens[k : k + p.length])] >= html.enough(len(hosts[host]), p) for j in range(k, k + p.length)}
        blocks = []
        for i, (text, kind) in enumerate(zip(page.texts, page.kinds)):
            places = [j for j, o in enumerate(owner) if o == i]
            if kind == html.OPEN and not gone.issuperset(places):
                short = {j for k, many in groupby(places, gone.__contains__) if k for run in [list(many)] if len(run) < p.length for j in run}
                blocks.append(" ".join(w for w, j in zip(text.split(), places[1:]) if j not in gone or j in short))
        out.append("\n\n".join(x for x in blocks if x))
    return out


@pytest.mark.parametrize("piece", [10**6, 60])
def test_pages_without_articles_equal_brute_force(spark, piece):
    """Also where a host is split into pieces."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(90):
        host = "hot" if i % 2 else f"h{i % 8}"
        own = " ".join(rng.choice(words, 25))
        menu = " ".join(words[:12]) if i % 7 else "another menu here"
        part = f"<p>{own} {' '.join(words[40:52])} {i}</p>" if i % 3 else f"<p>{own}</p>"  # a repeated run inside a block
        rows.append((i, f"http://{host}.example/{i}", f"<body><div>{menu}</div>{part}<div>{' '.join(words[60:75])}</div><div>short</div>"))
    rows += [(200 + k, rows[5][1], rows[5][2]) for k in range(30)]  # copies of a page repeat nothing
    p = html.Params(piece=piece)
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), p).collect()}
    want = dict(zip([r[0] for r in rows], brute_texts(rows, p)))
    assert got == want
    assert got[5] == want[205] and any("w45" in t for t in want.values()) and not all("w45" in t for i, t in want.items() if i % 3)


def test_copies_of_a_page_keep_their_text(spark):
    rows = [(i, "http://one.example", "<div>a page of which the crawl has many copies, all of them the same</div>") for i in range(40)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"a page of which the crawl has many copies, all of them the same"}


@pytest.mark.parametrize("piece", [html.ARTICLES.piece, 150])
def test_the_template_inside_articles_goes(spark, piece):
    """What nearly all articles of a host hold, as whole blocks; also where a host is split into pieces."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(3000)]
    notice, usual = "Sign up here to get our best stories of the week by mail", "a passage that half of the authors of this host like to quote"

    def page(blocks, beside=""):
        return f"<body><div>{beside}</div><article>{''.join(f'<p>{b}</p>' for b in blocks)}</article>"

    want, rows = {}, []
    for i in range(40):  # the notice is in 38 of 40
        text = [" ".join(rng.choice(words, 30)) for _ in range(2)] + [usual] * (i % 2)
        rows.append((i, "http://a.example/x", page([text[0], *[notice] * (i % 20 > 0), "Follow us", *text[1:]], f"beside {i}")))
        want[i] = "\n\n".join([text[0], "Follow us", *text[1:]])
    rows += [(40 + k, "http://a.example/y", page([f"{notice} {k}"], k)) for k in range(3)]  # more than the template: stays
    rows += [(50 + k, "http://b.example/x", page([notice, f"own words {k}"])) for k in range(4)]  # too few to tell
    long = " ".join(rng.choice(words, 60))
    rows += [(60 + k, "http://c.example/x", page([f"version {k}", long, notice], k)) for k in range(9)]  # versions of an article
    rows += [(70 + k, "http://d.example/x", page([long, notice], k)) for k in range(9)]  # one article under many adverts
    for i, _, h in rows[40:]:
        want[i] = "\n\n".join(t for t, k in zip(html.parse(h).texts, html.parse(h).kinds) if k == html.TEXT)
    inner = html.Params(pages=html.ARTICLES.pages, share=html.ARTICLES.share, piece=piece)
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), inner=inner).collect()}
    assert got == want


@pytest.mark.parametrize(
    "inner,text",
    [
        ('<article><section id="side-effects">one</section><div class="social-policy">two</div></article>', "one\n\ntwo"),
        ('<article class="post related-links">three</article>', "three"),
        ('<article><p>a</p><div class="share-buttons">x</div><div id="comments">y</div><div class="post-content advert-free">b</div></article>', "a\n\nb"),
        ('<article><div class="ad-banner top">x</div><div class="siteNav">y</div><div class="addition">c</div></article>', "c"),
        ('<article><section class="related">d</section><section class="newsletter-signup">x</section></article>', "d"),
    ],
)
def test_names_of_parts(inner, text):
    page = html.parse(f"<body>{inner}</body>")
    assert "\n\n".join(t for t, k in zip(page.texts, page.kinds) if k == html.TEXT) == text


@pytest.mark.parametrize("source", ["<div><b>" * 80_000 + "</p>" * 80_000, "<a " * 300_000, "<p><i>x" * 100_000, "</i></section>" * 80_000, "<div '" * 100_000 + ">"])
def test_long_broken_pages_take_linear_time(source):
    began = time.process_time()
    html.parse(source)
    assert time.process_time() - began < 8


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([(1, "http://h", "<p>x</p>", "a", 1)], "page_id long, url string, html string, host string, key int")
    assert html.extract(df.limit(0)).count() == 0
    assert [tuple(r) for r in html.extract(df).collect()] == [(1, "http://h", "x", 1)]


def test_every_page_of_the_table(spark, tiny):
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    got = {r.page_id: r for r in html.query(spark, tiny).collect()}
    assert got.keys() == pages.keys()
    for i, h in pages.items():
        body = re.search(r"<article>(.*)</article>", h, re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", body)
        import html as e

        want = [" ".join(e.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
        assert got[i].text == "\n\n".join(w for w in want if w)
