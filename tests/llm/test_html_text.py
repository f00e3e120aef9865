"""Main text of pages: blocks, parts set apart, votes of a host, odd pages."""

from plumbline.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- no --><div class="ad">Buy</div><div id="cookie-notice">Cookies</div>
<article><h1>Head &amp; more</h1><p><b>First&nbsp;&#8212; line<br>goes   on.<p>Second, longer block of text. It has sentences.</p>
<form><input value="x"><button>Send</button></form><ul><li>one</li><li>two <a href="#">link</a></ul><noscript>n</noscript>
<section class="comments"><p>Reader comment, long enough to look like text. Really.</p></section></article>
<aside>Side</aside><footer>&copy; host &middot; foot</footer></body></html>"""


def page(body):
    return f"<html><body>{body}</body></html>"


def extract(spark, rows):
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id bigint, url string, html string, host string, path int")
    return html_text.extract(frame).collect()


def test_blocks(spark):
    got = extract(spark, [(1, "http://h.example/a", PAGE)])
    want = "Head & more\nFirst — line goes on.\nSecond, longer block of text. It has sentences.\none\ntwo link"
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [(1, "http://h.example/a", want, len(want))]


def test_host_votes_decide(spark):
    usual = page("<div class='post-12'><p>Some running text, with words. And more of it, here.</p></div><div class='extra'><p>x</p></div>")
    odd = page("<div class='post-77'><p>Short one.</p></div><div class='extra'><p>A very long other part, with lots of words. It would win alone. "
               "It goes on, and on, and on.</p></div>")
    rows = [(i, f"https://user@Host.example:80/{i}", usual) for i in range(5)] + [(9, "//host.example", odd), (10, "http://lone.example", odd)]
    got = {r.page_id: r.text for r in extract(spark, rows)}
    assert got[9] == "Short one." and got[10].startswith("A very long") and got[0].startswith("Some running")


def test_page_without_the_winning_path(spark):
    usual = page("<article><p>Some running text, with words. And more.</p></article>")
    rows = [(i, "http://h.example", usual) for i in range(3)] + [(7, "http://h.example", page("<div><p>Another layout, this one.</p></div>"))]
    assert {r.page_id: r.text for r in extract(spark, rows)}[7] == "Another layout, this one."


def test_odd_pages(spark):
    long = page("<article>" + "<p>word &lt;x&gt; text</p>" * 20_000 + "</article>")
    rows = [(1, None, None), (2, "", ""), (3, "no url", "plain text only"), (4, "http://a", page("<nav>only menu</nav>")), (5, "http://b", long),
            (6, "http://c", "<article><p>cut off &am"), (6, "http://c", "<article><p>cut off &am"), (7, "http://d", "<p>a < b and c > d &#x41;&amp"),
            (8, "http://e", "<article><p>one<!-- never closed"), (9, "http://f", "<script>never closed"), (None, "http://g", "<div" + " a='<p>'" * 10),
            (11, "http://h", page("<table><tr><td>a<td>b<tr><td>c</table>")), (12, "http://i", "<article>" + "<div>" * 3000 + "deep")]
    got = extract(spark, rows)
    assert len(got) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert text[1] == text[2] == text[4] == text[9] == text[None] == ""
    assert text[5] == "\n".join(["word <x> text"] * 20_000) and text[6] == "cut off &am" and text[8] == "one" and text[12] == "deep"
    assert text[3] == "plain text only"
    assert text[7] == "a < b and c > d A&" and text[11] == "a\nb\nc"
    assert extract(spark, []) == []


def test_ties_go_to_the_first_path(spark):
    both = page("<div class='b'><p>Same text here.</p></div><div class='a'><p>Same text here.</p></div>")
    got = extract(spark, [(i, "http://t.example", both) for i in range(4)])
    assert len({r.text for r in got}) == 1


def test_what_stands_around_the_winner_belongs_to_it(spark):
    body = "<p>Long running text, with words. " + "And more of it, on and on. " * 40 + "</p>"
    links = "<ul class='more'>" + "<li><a href='/x'>Another page of this host</a></li>" * 9 + "</ul>"
    article = page(f"<article><h1>Title</h1><p>The lead.</p><div class='entry-content'>{body}</div><div class='after'><p>Sibling.</p></div>"
                   "<div class='share'>Share</div></article><p>Outside</p>")
    neutral = page(f"<div class='w-1/2'><div class='lead'>The lead.</div><div class='text'>{body}</div></div>")
    linked = page(f"<div class='box'>{links}<div class='text'>{body}</div></div>")
    rows = [(10 * h + i, f"http://h{h}.example/{i}", source) for h, source in enumerate((article, neutral, linked)) for i in range(3)]
    rows.append((40, "http://h0.example/odd", page(f"<section><div class='lead'>The lead.</div><div class='text'>{body}</div></section>")))
    got = {r.page_id: r.text.split("\n") for r in extract(spark, rows)}
    assert [x[:9] for x in got[0]] == ["Title", "The lead.", "Long runn", "Sibling."]
    assert [x[:9] for x in got[10]] == ["The lead.", "Long runn"] and [x[:9] for x in got[20]] == ["Long runn"]
    assert [x[:9] for x in got[40]] == ["The lead.", "Long runn"]


def text_of(source):
    return html_text.Page(source).text(None)


REPRODUCED = [
    ("<html><head><title>x</title><p>Hello</p></html>", "Hello"),
    ("<head><meta charset=utf-8><title>T</title><h1>Top</h1><p>Text.</p>", "Top\nText."),
    ("<body><div class='post ad-free'><p>Kept, all of it.</p></div></body>", "Kept, all of it."),
    ("<body><article><section class='social-history'><p>Past.</p></section><div class='notice-board'><p>Board.</p></div><p data-id=share>Id.</p></article>",
     "Past.\nBoard.\nId."),
    ("<body><nav>menu</nav><h1>TITLE</h1><p>LEAD</p><section><p>Long running text, here. And more of it, there.</p></section></body>",
     "TITLE\nLEAD\nLong running text, here. And more of it, there."),
    ("<article><header><h1>TITLE</h1><p>Byline</p></header><p>Text.</p><footer>tags</footer></article><header>Site</header>", "TITLE\nByline\nText."),
    ("<p title=it's>One</p><p>Two, it's here.</p>", "One\nTwo, it's here."),
    ("<p title=\"a>b\" data-x='c>d' checked>One</p>", "One"),
    ("<article><p>Go <a class='ad'>Buy</a> on.</p></article>", "Go on."),
    ("<article><p>Go <span class='ad'>Buy <span>now</span> cheap</span> on.</p></article>", "Go on."),
    ("<article><p>a <button>PRESS</button> b <label>L</label> c</p></article>", "a b c"),
    ("<article><a class='promo' href='/x'><div>Buy</div></a><p>Text <b>bold</i></b>.</p></article>", "Text bold."),
    ("<article><p>Text</p><div class='cookieBanner'>C</div><div class='site-footer'>F</div><div class='post-comments'>R</div><div id='sidebar-left'>S</div>"
     "<div role='navigation'>N</div><div class='has-sidebar'>H</div></article>", "Text\nH"),
    ("<main><header class='page-header'><h1>T</h1></header><p>x</p></main>", "T\nx"),
]


def test_reproduced_losses_and_leaks():
    for source, want in REPRODUCED:
        assert text_of(source) == want, source


JUNK = ["<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<div class='ads-top'><p>Buy this, now. It is good.</p></div>", "<form><input><button>Go</button></form>",
        "<aside><p>Also read, on this site. More.</p></aside>", "<div id='comments'><p>First! I say, so long. And so on.</p></div>",
        "<script>var a = '<p>no</p>';</script>", "<div class='share-buttons'><a href='#'>Share</a></div>"]
LAYOUTS = [
    "<html><head><title>t</title></head><body>{j}<article>{a}{j}</article>{j}<footer>f</footer></body></html>",
    "<body><header>Site</header>{j}<main>{a}</main>{j}</body>",
    "<body>{j}<div class='wrapper has-sidebar'><div class='post-content'>{a}</div>{j}</div></body>",
    "<body>{j}{a}{j}</body>",
    "<html>{j}<body class='no-ads'><div id=page><div class='entry'>{a}{j}</div></div>{j}",
    "<body><table><tr><td>{a}</td></tr></table>{j}</body>",
    "<article><div><div><div>{a}</div></div>{j}</div></article>{j}",
    "{j}<section class='social-history'>{a}</section>{j}",
    "<body>{j}<article>{j}{a}</article></body>",
    "<body><div><div><div><div><div class=\"it's\" title=it's>{a}</div></div></div></div></div>{j}</body>",
    "<body>{j}<main><header>{h}</header>{a}<footer>end</footer></main></body>",
]


def test_layouts_made_of_known_blocks(spark):
    """Pages are put together of known article blocks and junk, so the text is known without reading the page."""
    import random
    rng, rows, want = random.Random(2), [], {}
    for layout, source in enumerate(LAYOUTS):
        for k in range(6):
            blocks = [" ".join(rng.choice("some words of a text, that runs. on and &amp; ends".split()) for _ in range(rng.randrange(8, 40)))
                      for _ in range(rng.randrange(3, 7))]
            head = f"Title {k}"
            made = "".join(f"<{t}>{b}</{t}>" for t, b in zip(["h1", "p", "p", "blockquote", "p", "p", "p"], blocks))
            page_id = layout * 10 + k
            body = source.replace("{h}", f"<h1>{head}</h1>").replace("{a}", made)
            while "{j}" in body:
                body = body.replace("{j}", "".join(rng.sample(JUNK, 2)), 1)
            rows.append((page_id, f"http://host{layout}.example/{k}", body))
            want[page_id] = "\n".join(([head] if "{h}" in source else []) + [b.replace("&amp;", "&") for b in blocks])
    got = {r.page_id: r.text for r in extract(spark, rows)}
    assert {i: t for i, t in got.items() if t != want[i]} == {}
