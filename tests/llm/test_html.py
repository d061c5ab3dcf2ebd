import html as plain
import random
import re
import time

import numpy as np
from conftest import TESTDATA
from helpers import frame, rows

from jobtide.llm import html

SCHEMA = "page_id long, url string, html string"


def text(spark, page, url="http://h.example/1"):
    return rows(html.extract(frame(spark, [(1, url, page)], SCHEMA)).select("text"))[0][0]


def test_articles_of_pages(spark):
    pages = spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    for page_id, _, page in rows(pages.select("page_id", "url", "html")):
        inside = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
        parts = [" ".join(plain.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert got[page_id] == "\n".join(p for p in parts if p)


def test_parts_that_are_left_out(spark):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><p>no";</script></head>
    <body><!-- <p>no</p> --><header>no</header><nav><ul><li>no</ul></nav><div class="cookie-notice">no <div>no</div></div>
    <main><article><header><h1>Yes &amp; more</h1></header><p>One<b> two</b>&nbsp;three<br>four<p>five &lt;six&gt; &#233;
    <div class="ad big">no</div><aside>no</aside><form>no<input value=">"></form><ul><li>a<li>b</ul>
    <section id="comments"><p>no</p></section><p title="a > b">end</p></article></main><footer>no</footer></body></html>"""
    want = "Yes & more\nOne two three four\nfive <six> é\na\nb\nend"
    assert text(spark, page) == want


def test_broken_and_odd_pages(spark):
    docs = [(1, None, None), (2, "", ""), (3, "x", "no markup < here & there"), (4, "http://H.example:80/a", "<p>a<!-- open"), (5, None, "<script>only"), (5, None, "<article><p>same id"), (None, "//h/x", "<p"), (7, "u", "<article>" + "<div>" * 3000 + "deep" + "</p>" * 3000), (8, "u", "<article><p>" + "word " * 200_000)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA + ", host string, text int").repartition(3)
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "text"]
    found = sorted((str(k), t) for k, _, t in rows(got))
    long = " ".join(["word"] * 200_000)
    assert found == sorted([("1", ""), ("2", ""), ("3", "no markup < here & there"), ("4", "a"), ("5", ""), ("5", "same id"), ("None", ""), ("7", "deep"), ("8", long)])
    assert rows(html.extract(df.limit(0))) == []


def test_boilerplate_of_a_host_goes_where_no_article_is_marked(spark):
    rng = random.Random(1)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    bodies = [say(40) for _ in range(30)]
    pages = [(i, f"https://h.example/{i}", f"<body><div>Home Products About Contact us</div><div>{b}</div><div>All rights of Example Inc are reserved {i}</div></body>") for i, b in enumerate(bodies)]
    pages += [(99, "https://other.example/", "<body><div>Home Products About Contact us</div></body>")]
    for shard in (256, 5):
        got = {r["page_id"]: r["text"] for r in html.extract(frame(spark, pages, SCHEMA), per_shard=shard).collect()}
        assert [got[i] for i in range(30)] == [f"{b}\n{i}" for i, b in enumerate(bodies)]
        assert got[99] == "Home Products About Contact us"


def test_an_article_that_two_pages_share_stays(spark):
    page = "<article><p>one two three four five six seven</p></article>"
    got = rows(html.extract(frame(spark, [(1, "http://h/1", page), (2, "http://h/2", page)], SCHEMA)).select("text"))
    assert got == [("one two three four five six seven",)] * 2


def test_covered_equals_plain_search():
    rng = random.Random(7)
    for _ in range(60):
        streams = [np.array([rng.randrange(3) for _ in range(rng.randrange(0, 14))], np.int64) for _ in range(rng.randrange(1, 6))]
        for least in (1, 2, 3, 4, 5, 7):
            seen = {}
            for p, s in enumerate(streams):
                for i in range(len(s) - least + 1):
                    seen.setdefault(tuple(s[i : i + least]), set()).add(p)
            for s, got in zip(streams, html.covered(streams, least), strict=True):
                want = np.zeros(len(s), bool)
                for i in range(len(s) - least + 1):
                    if len(seen[tuple(s[i : i + least])]) > 1:
                        want[i : i + least] = True
                assert got.tolist() == want.tolist()


def test_quotes_in_tags(spark):
    """A quote opens a string only as the first sign of a value."""
    assert text(spark, "<a title=don't>one</a> two <p>three it's four</p><p>five</p>") == "one two\nthree it's four\nfive"
    assert text(spark, "<p title = 'a > b' x=\"c > d\" y=e'f>in</p>out") == "in\nout"
    assert text(spark, "<p title='open>gone") == ""


def test_parts_beside_and_in_an_article(spark):
    page = "<main><p>Latest deals today</p><article class='post banner'><div class='post-header'><h1>Title</h1></div><p>Text</p></article></main>"
    assert text(spark, page) == "Title\nText"
    assert text(spark, "<p>out</p><main><p>Only the main part</p></main>") == "Only the main part"
    assert text(spark, "<div class='page-header'>no</div><p>yes</p>") == "yes"


def test_end_tags_without_a_start_take_no_time():
    page = "<article>" + "<b>x</i>" * 20_000
    start = time.perf_counter()
    assert html.blocks(page) == [("x" * 20_000, 3)]
    assert time.perf_counter() - start < 2


def test_a_block_on_most_pages_goes_from_marked_articles(spark):
    """An unnamed notice goes; a passage some pages share, and copies of a whole page, stay."""
    rng = random.Random(2)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, bodies = say(60), [say(30) for _ in range(30)]
    bodies[:5] = [f"{b}</p><p>{passage}" for b in bodies[:5]]
    bodies += [bodies[9]] * 3
    notice = "Please read our terms before you go on"
    pages = [(i, f"https://h.example/{i}", f"<article><p>{b}</p><div>{notice}</div></article>") for i, b in enumerate(bodies)]
    pages += [(100 + i, f"https://few.example/{i}", f"<article><p>{b}</p><div>{notice}</div></article>") for i, b in enumerate(bodies[:3])]
    got = {r["page_id"]: r["text"] for r in html.extract(frame(spark, pages, SCHEMA)).collect()}
    want = [b.replace("</p><p>", "\n") for b in bodies]
    assert [got[i] for i in range(33)] == want
    assert [got[100 + i] for i in range(3)] == [f"{b}\n{notice}" for b in want[:3]]


def test_phrases_and_copies_stay_on_unmarked_pages(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    bodies = [f"{say(20)} at the end of the {say(20)}" if i < 4 else say(40) for i in range(40)]
    bodies.append(bodies[7])
    pages = [(i, f"https://h.example/{i}", f"<div>Home Products About Contact us</div><div>{b}</div>") for i, b in enumerate(bodies)]
    pages += [(50 + i, "https://two.example/", "<div>one text two times it is</div>") for i in range(2)]
    got = {r["page_id"]: r["text"] for r in html.extract(frame(spark, pages, SCHEMA)).collect()}
    assert [got[i] for i in range(41)] == bodies
    assert got[50] == got[51] == "one text two times it is"


def test_a_host_of_any_size_loses_the_same(spark):
    rng = random.Random(4)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    for n in (60, 1500):
        menu = "<div>Section one two three four five</div>"
        bodies = [say(12) for _ in range(n)]
        pages = [(i, "https://h.example/", f"{menu if i % 2 else ''}<div>{b}</div>") for i, b in enumerate(bodies)]
        got = {r["page_id"]: r["text"] for r in html.extract(frame(spark, pages, SCHEMA)).collect()}
        assert [got[i] for i in range(n)] == bodies
