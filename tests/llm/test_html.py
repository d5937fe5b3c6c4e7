"""Main text: exact on a known template, consensus repairs odd pages, parsing rules, odd inputs."""

from loomweave.llm import html_consensus as H

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><div class="ad">Buy now, a long advert text that goes on and on.</div>
<div class="post p12"><h1>Title&nbsp;one</h1><p>First   <b>bold</b><br>line &lt;x&gt;<p>Second.<!-- no <p>this</p> --><ul><li>one<li>two</ul>
<aside>Aside</aside><form><p>Form</p></form><div class="cookie-notice">We use cookies</div><p>Last %s</p><section class="comments"><p>A reader says so.</p></section></div>
<div class="sidebar"><p>Other</p></div><footer>&copy; me</footer></body></html>"""
WANT = "Title one\n\nFirst bold line <x>\n\nSecond.\n\none\n\ntwo\n\nLast %s"


def page(k):
    return PAGE % (f"paragraph number {k} " * 8), WANT % (f"paragraph number {k} " * 8).strip()


def test_template(spark):
    rows, want = [], {}
    for k in range(40):
        html, text = page(k)
        rows.append((k, f"https://Host.example/{k}?x#y", html, 1, "x"))
        want[k] = text
    # an odd page of the host: its longest container is a list of quotes, the consensus path still wins
    odd = '<html><body><div class="post p99"><p>Short.</p></div><div class="wall"><p>%s</p></div></body></html>' % ("quote " * 60)
    rows += [(100, "https://host.example/odd", odd, 1, "x"), (101, None, None, 1, "x"), (102, "::bad[", "", 1, "x"), (103, "http://else.example/", "plain text\n only", 1, "x"),
             (104, "https://host.example/none", "<html><body><main><p>Alone here.</p></main></body></html>", 1, "x"), (5, "https://host.example/5", rows[5][2], 1, "x")]
    want |= {100: "Short.", 101: "", 102: "", 103: "plain text only", 104: "Alone here."}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int, path string")
    for limit in (H.BROADCAST_ROWS, 0):
        old, H.BROADCAST_ROWS = H.BROADCAST_ROWS, limit
        try:
            got = H.main_text(df).collect()
        finally:
            H.BROADCAST_ROWS = old
        assert len(got) == len(rows)
        for r in got:
            assert r.text == want[r.page_id] and r.n_chars == len(r.text), (r.page_id, r.text)
    assert H.main_text(df.limit(0)).collect() == []


def test_paths_are_generalised():
    a, b = (H.best_path(page(k)[0]) for k in (1, 2))
    assert a == b == "html/body/div.p#.post"


def test_adversarial_pages_end():
    for t in ("<" * 50_000, "<div>" * 20_000 + "x", "<a b=\"" * 5_000, "<p>" * 30_000, "</div>" * 30_000, "<!--" * 20_000, "<script>" * 5_000, "&" * 50_000, "x" * 200_000):
        H._page_text(t, ["html/body"])


def test_a_rare_template_uses_its_own_container(spark):
    links = "".join(f'<div class="t{k}"><a href="/{k}">Teaser number {k} of many</a></div>' for k in range(20))
    rare = f'<html><body><div class="x1">{links}</div><div class="x2"><p>%s</p><p>Its second paragraph, <a href="/y">linked</a>.</p></div><div class="box">Some box beside it</div></body></html>'
    text = "An article of a template that few pages have. " * 5
    rows = [(k, "https://host.example/", page(k)[0]) for k in range(40)] + [(50, "https://host.example/rare", rare % text)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.main_text(df).collect()}
    assert got[50] == f"{text.strip()}\n\nIts second paragraph, linked."
    assert got[7] == page(7)[1]
    bare = rare.replace(' class="x1"', "").replace(' class="x2"', "")       # list and article on one path
    assert H._page_text(bare % text, ["html/body/div.post"]) == H._page_text(bare % text, []) == got[50]
    # a winner without text on the page does not stand in the way either
    assert H._page_text(rare % text, ["html/body/div.x#/div.t#/div", "html/body/div.post"]) == got[50]


def test_class_words_and_forms_do_not_drop_the_page():
    text = "A paragraph of the article that has some length. " * 4
    body = f"<h1>Title</h1><p>{text}</p>"
    want = f"Title\n\n{text.strip()}"
    rest = '<nav>menu</nav><div class="sidebar"><p>Other</p></div><section class="comments"><p>A reader.</p></section><footer>me</footer>'
    for html in (f'<html class="no-banner"><body class="has-sidebar">{body}{rest}</body></html>', f'<body><main id="comment-policy">{body}</main>{rest}</body>',
                 f'<body><article class="post has-sidebar tags">{body}</article>{rest}</body>', f'<body><div>Skip</div><form id="aspnet"><div class="p">{body}</div>{rest}</form></body>',
                 f'<body><div class="page sidebar-right">{body}{rest}</div></body>', f'<body><div class="widget"><p>{text}</p></div></body>',
                 f'<body><div id="related-works"><div><p>{text}</p></div>{rest}</div></body>', f'<body><form><p>{text}</p>{rest}</form></body>'):
        got = H._page_text(html, [])
        assert got == (want if "<h1>" in html else text.strip()), html
        assert H._page_text(html, [H.best_path(html)]) == got
    # words still mark parts, and short articles beside long comments stay
    many = "".join(f'<article class="comment"><p>{text}</p></article>' for _ in range(5))
    for html in (f'<body><div class="post"><h1>T</h1><p>Short.</p></div><div class="comments">{many}</div></body>', f'<body><div class="post"><h1>T</h1><p>Short.</p></div>{many}</body>',
                 f'<body><article><h1>T</h1><p>Short.</p>{many}</article></body>', f'<body><div class="post"><h1>T</h1><p>Short.</p></div><form><p>Your name</p></form><div class="cookie"><p>{text}</p></div></body>'):
        assert H._page_text(html, []) == "T\n\nShort.", html


def test_missing_end_tags_lose_no_text():
    for part in ("<svg class=i />", '<svg viewBox="0 0 1 1"/>', "<svg/>", "<math/>", "<datalist id=d><option value=a><option value=b>B</datalist>", "<select><option>A<option>B</select>",
                 "<span><select><option>A</span>", "<span><button>Go</span>", "<span><svg><path d=x /></span>", "<button>Go <i>on</i></button>", "<svg><title>t</title></svg>", "<svg data=x/><text>t</text></svg>"):
        html = f"<body><div><p>One {part}two.</p><p>Three.</p></div><p>Four</p></body>"
        got = H._page_text(html, ["body"])
        assert " ".join(got.split()) == "One two. Three. Four", (part, got)
    assert H._page_text("<body><p>One <button><div>Go</div></button>two.</p></body>", ["body"]) == "One two."


def test_adversarial_marks_and_end_tags_end():
    for t in ("<svg>" * 30_000 + "x", "<button>" * 30_000 + "x", "<option>" * 30_000, "<select>" * 30_000, '<div class="ad">' * 20_000 + "x", "<form>" * 1_000 + "x", "<h1>" * 1_000 + "<article class=ad>" * 5_000, "<svg a=" + "=" * 50_000 + "/>x"):
        H._page_text(t, ["html/body"])


def test_layout_words_do_not_drop_articles():
    """Class words that tell how the page is laid out, with no h1, main or article inside the marked element."""
    text = "A paragraph of the article that has some length. " * 4
    four = "".join(f"<p>{text}</p>" for _ in range(4))
    want = "\n\n".join([text.strip()] * 4)
    side = '<div class="sidebar"><p>Other</p></div><div class="comments"><p>A reader.</p></div>'
    for html in (f"<body><div class='content has-sidebar'>{four}</div><div>Other small text.</div></body>", f"<body><div class='layout with-sidebar'><h2>Part</h2>{four}</div><div>Other small text.</div></body>",
                 f"<body><div class='row'><div class='content sidebar-left'>{four}</div>{side}</div></body>", f"<body><div class='row'><div class='sidebar-left'>{four}</div>{side}</div></body>",
                 f"<body><h1>T</h1><div class='row'><div class='entry-content sidebar-left'>{four}</div>{side}</div></body>"):
        got = H._page_text(html, [])
        assert want in got and "Other" not in got.replace("Other small", "") and "reader" not in got, html
    assert H._page_text(f"<body><main><p>Intro.</p><div class='col no-sidebar'>{four}</div></main></body>", []) == "Intro.\n\n" + want
    got = H._page_text(f"<body><article><h1>T</h1>{four}<h2 id='related-work'>Related work</h2><p>{text}</p><ul class='social'><li>{text}</li></ul><ul class='social'><li><a href=x>Tweet</a></li></ul></article></body>", [])
    assert got == f"T\n\n{want}\n\nRelated work\n\n{text.strip()}\n\n{text.strip()}"
    # a long sidebar beside an article with a heading is still one
    assert H._page_text(f"<body><div class='post'><h1>T</h1><p>Short.</p></div><div class='sidebar'>{four}</div></body>", []) == "T\n\nShort."


def test_headers_of_articles_at_any_depth():
    for k in (3, 9, 40):
        html = "<body><article>" + "<div>" * k + "<header><h1>Title</h1></header><p>Text.</p>" + "</div>" * k + "</article><header>Site</header></body>"
        assert H._page_text(html, []) == "Title\n\nText."


def test_odd_pages_take_time_in_proportion():
    import time

    mb = 1_000_000
    pages = {"open tags": "<a " * (mb // 3), "open quotes": '<p "' * (mb // 4), "other quotes": "<a href='x " * (mb // 11), "both quotes": "<a b='c\" " * (mb // 10), "ends of nothing": "<div>" * (mb // 10) + "</section>" * (mb // 20),
             "inline ends": "<b><div>" + "<i>" * (mb // 6) + "</b>" * (mb // 8), "paragraphs in spans": "<span>" * (mb // 12) + "<p>" * (mb // 6), "open declarations": "<!" * (mb // 2), "open ends": "</" * (mb // 2),
             "raw ends": "<script>" + "</script " * (mb // 9), "quotes then end": '<p "' * (mb // 4) + ">x", "comments": "<!-" * (mb // 3) + "<!--", "list items": "<ul><li>" * (mb // 16) + "<li>" * (mb // 8)}
    for name, page in pages.items():
        began = time.process_time()
        H._page_text(page, ["html/body/" + "div/" * 50 + "div"])
        assert time.process_time() - began < 6, name
    deep = "<html><body>" + "<div>" * 20_000 + "x" * 50 + "</div>" * 20_000
    began = time.process_time()
    path = H.best_path(deep)
    assert H._page_text(deep, [path, "html/body/div/div"]) == "x" * 50 and time.process_time() - began < 6


def plain_text(page):
    """An independent small extractor for well-formed pages of one template, on the standard library's parser."""
    from html.parser import HTMLParser

    blocks = set("p h1 h2 h3 li div ul section blockquote".split())

    class P(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.out, self.now = [], [], ""

        def cut(self):
            text = " ".join(self.now.split())
            self.out += [text] if text else []
            self.now = ""

        def handle_starttag(self, tag, attrs):
            if tag in blocks:
                self.cut()
            if tag != "br":
                self.stack.append((tag, dict(attrs).get("class", "")))
            else:
                self.now += " "

        def handle_endtag(self, tag):
            if tag in blocks:
                self.cut()
            self.stack.pop()

        def handle_data(self, data):
            if any(c == "story" for _, c in self.stack) and not any(t in ("script", "aside", "form") or c in ("comments", "ad") for t, c in self.stack):
                self.now += data

    p = P()
    p.feed(page)
    p.cut()
    return "\n\n".join(p.out)


def test_equals_a_plain_extractor(spark):
    import random

    rng = random.Random(6)
    words = "water &amp; stone caf&eacute; river &lt;b&gt; boat hill &#8217; other".split()

    def prose(n):
        return " ".join(rng.choice([w, w, w, f"<b>{w}</b>", f"<a href='/x'>{w}</a>", f"<i>{w}", ][:5]) for w in rng.choices(words, k=n))
    parts = [lambda: f"<p>{prose(30)}</p>", lambda: f"<h2>{prose(3)}</h2>", lambda: f"<ul><li>{prose(5)}</li><li>{prose(9)}</li></ul>", lambda: f"<blockquote><p>{prose(12)}</p></blockquote>",
             lambda: f"<div class='ad'><p>{prose(9)}</p></div>", lambda: f"<aside><p>{prose(9)}</p></aside>", lambda: f"<form><p>{prose(3)}</p></form>", lambda: "<script>var a = '<p>x</p>';</script>", lambda: f"<p>{prose(4)}<br>{prose(4)}</p>"]
    rows = []
    for k in range(60):
        inner = "".join(rng.choice(parts)() for _ in range(rng.randrange(2, 12)))
        rows.append((k, f"http://h{k % 3}.example/{k}", f"<html><body><nav><p>{prose(4)}</p></nav><div class='story'><h1>{prose(4)}</h1><p>{prose(40)}</p>{inner}<section class='comments'><p>{prose(20)}</p></section></div><footer><p>{prose(5)}</p></footer></body></html>"))
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, _, page in rows:
        assert got[k] == plain_text(page), k


def test_packed_winners_are_the_winners(spark):
    rows = [(f"h{i}.example" if i else "", [f"html/body/div.t{i % 5}", "html/body/main", f"p{i % 3}"][: 1 + i % 3]) for i in range(3000)]
    rows += [("\u043f\u0440\u0438\u043c\u0435\u0440.example", ["html/body"])]
    packed = H._packed(spark.createDataFrame(rows, "host string, paths array<string>"))
    assert len(packed[2]) == 8 and all(H._looked_up(packed, h) == p for h, p in rows)
    assert H._looked_up(packed, "other.example") == []
    none = H._packed(spark.createDataFrame([], "host string, paths array<string>"))
    assert H._looked_up(none, "") == []


def test_packed_bounds(spark):
    won = spark.createDataFrame([("a", ["x"]), ("b", ["y" * 300])], "host string, paths array<string>")
    for name, limit in (("BROADCAST_ROWS", 1), ("BROADCAST_BYTES", 200)):
        old = getattr(H, name)
        setattr(H, name, limit)
        try:
            assert H._packed(won) is None
        finally:
            setattr(H, name, old)
