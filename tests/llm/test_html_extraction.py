import random
import re
from html import unescape

import pyarrow.parquet as pq

from folio.llm import html_extraction as H

PROSE = "The quick brown fox was in the garden and it is said that he had been there with his friends for a long time before the rain came to the hills."
OTHER = "When the evening was near, they went to the house by the river and sat at the table with bread, and the old man told them of the war that he had seen."


def page(inner, before="", after="", container="article"):
    return f"<!DOCTYPE html><html><head><title>T &amp; U</title><script>if (a < b) {{ document.write('<p>no</p>') }}</script><style>p{{}}</style></head><body>{before}<{container}>{inner}</{container}>{after}</body></html>"


def test_rules():
    noise_before = '<header class="site"><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">One</a></li><li>Two</li></ul></nav><div class="cookie-notice">We use cookies and the site is for you and that is it.</div>'
    noise_after = f'<aside>{PROSE}</aside><div id="comments"><p>{OTHER}</p></div><form><label>Name</label><input><button>Send</button></form><footer>&copy; all of it {PROSE}</footer><!-- <p>{PROSE}</p> -->'
    inner = f"<h1>Head &amp; line</h1><p>{PROSE}</p><p>Short one.</p><p>A <a href='x'>link</a> in\n  it &nbsp; &lt;ok&gt;<br>next</p><div class='ad'>Buy it now</div><p>{OTHER}"
    want = "\n\n".join(["Head & line", PROSE, "Short one.", "A link in it <ok> next", OTHER])
    assert H.main_text(page(inner, noise_before, noise_after)) == want
    assert H.main_text(page(inner, noise_before, noise_after, "main")) == want
    # without an article element the rules alone decide
    assert H.main_text(page(f"<h2>Of the garden</h2><p>{PROSE} {OTHER}</p><p>And so.</p><p>{OTHER} {PROSE}</p>", noise_before, noise_after, "div")) == "\n\n".join(["Of the garden", f"{PROSE} {OTHER}", "And so.", f"{OTHER} {PROSE}"])
    assert H.main_text(page("<p>Tiny.</p>")) == "Tiny."


def test_odd_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<html><body></body></html>") == ""
    for bad in ("<", "<p", "<a href='", "<!-- open", "<script>never closed", "&#0;&#xD800;&bogus;", "</p></div></article>", "<div " * 50, "<<>><p></", "\x00<p>\x00"):
        assert isinstance(H.main_text(bad), str)
    rng = random.Random(2)
    for _ in range(200):
        H.main_text("".join(rng.choice(["<p>", "</p>", "<article>", "</article>", "<nav>", "<a>", "x ", "&amp;", "<", "'", '"', "<!--", "-->", "<br/>", "<script>"]) for _ in range(40)))


def test_tables(spark):
    html = pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()
    for row in html:
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", row["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert H.main_text(row["html"]) == "\n\n".join(p for p in parts if p)
    df = spark.createDataFrame([(1, "u", "<p>x</p>", "t"), (2, None, None, "t"), (2, None, None, "t")], "page_id long, url string, html string, text string")
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in H.extract(df).orderBy("page_id").collect()] == [(1, "u", "", 0), (2, None, "", 0), (2, None, "", 0)]
    assert H.extract(df.limit(0)).collect() == []


def test_wrappers_of_most_of_the_text():
    text = f"<p>{PROSE} {OTHER}</p><p>{OTHER} {PROSE}</p>"
    want = f"{PROSE} {OTHER}\n\n{OTHER} {PROSE}"
    for start, end in (("<div class='content no-sidebar'>", "</div>"), ("<main class='has-sidebar'>", "</main>"), ("<article class='post no-comments'>", "</article>")):
        assert H.main_text(f"<html><body><nav>Menu</nav>{start}{text}{end}</body></html>") == want
    # what is named inside a pardoned wrapper stays out, and so do compounds that enclose little
    assert H.main_text(f"<div class='no-sidebar'>{text}<div class='comments'><p>{OTHER} {PROSE} {OTHER} {PROSE} {OTHER} {PROSE} {OTHER}</p></div></div>") == want
    assert H.main_text(f"<div>{text}</div><div class='post-comments'><p>{PROSE} {OTHER}</p></div>") == want


def test_teaser_card_is_not_the_page():
    text = f"<p>{PROSE} {OTHER}</p><p>{OTHER} {PROSE}</p><p>{PROSE} {OTHER}</p>"
    got = H.main_text(f"<html><body><div>{text}</div><article><p>A card of few words.</p></article></body></html>")
    assert f"{PROSE} {OTHER}\n\n{OTHER} {PROSE}\n\n{PROSE} {OTHER}" in got


def test_densities_decide(monkeypatch):
    listing = "zrk0 qplx vbn2 wrtz kkjh mnbv plok qazx wsxe dcrf vtgb yhnu jmik olpz qwer tyui opas dfgh"
    page_of = lambda inner: f"<html><body><div><p>{PROSE} {OTHER}</p><p>{OTHER} {PROSE}</p></div>{inner}</body></html>"
    want = [f"{PROSE} {OTHER}", f"{OTHER} {PROSE}"]
    # an article without running text decides nothing, and one with it takes its thin blocks along
    assert H.main_text(page_of(f"<article><p>{listing}</p></article>")) == "\n\n".join(want)
    assert H.main_text(f"<article><p>{PROSE} {OTHER}</p><pre>{listing}</pre><p>{OTHER} {PROSE}</p></article>") == "\n\n".join([want[0], listing, want[1]])
    # prose outside an article stays
    assert H.main_text(f"<body><div><p>{PROSE} {OTHER}</p></div><article><p>{OTHER} {PROSE}</p></article></body>") == "\n\n".join(want)
    # inside an article a doubtful name leaves the verdict to the densities
    parts = f"<p>{PROSE} {OTHER}</p><section class='related'><p>{OTHER} {PROSE}</p><p>See also</p><p>{listing}</p></section>"
    assert H.main_text(f"<article>{parts}</article>") == "\n\n".join(want)
    before = H.main_text(f"<article>{parts}</article>")
    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()]
    monkeypatch.setattr(H, "STOP_WORDS", frozenset())
    assert H.main_text(page_of("<article><p>Und so weiter und so fort in Worten, die hier keiner kennt, aber doch liest</p></article>")) == "\n\n".join(want)
    assert H.main_text(f"<article><p>{PROSE}</p><p>{PROSE}</p></article>") == ""
    assert before and all(isinstance(H.main_text(x), str) for x in pages)


def test_void_elements_and_formulas():
    text = f"<p>{PROSE} {OTHER}</p>"
    assert H.main_text(f"<article>{text}<embed src=x><p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>{text}</article>") == f"{PROSE} {OTHER}\n\nWhere x=2 holds.\n\n{PROSE} {OTHER}"


def test_long_pages_take_linear_time():
    import time

    page = "<article>" + "<p>A few.</p>" * 12_000 + f"<p>{PROSE} {OTHER}</p></article>"
    began = time.process_time()
    assert H.main_text(page).count("A few.") == 12_000
    assert time.process_time() - began < 5
