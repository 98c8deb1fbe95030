"""Articles of pages: markup rules, templates per host, edge rows."""

from pyspark.sql import functions as F

from tallyloom.llm import webpages as w


def text_of(html, template=()):
    return w.article_blocks(w.parse(html), set(template))


def test_article_and_what_is_not():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav><div class="ad">Buy</div>
    <article><header><h1>Head &amp; tail</h1></header><p>One  two<br>three&nbsp;&lt;b&gt; &#233;</p><div class="share">Share</div>
    <p><b>Four<br><p>Five<!-- no <p>comment</p> --> six</p><aside>Aside</aside><form><p>Mail</p></form>
    <ul><li>a<li>b</ul><div id="comments"><article><p>first!</p></article></div></article>
    <div class="cookie-notice">Cookies</div><footer>&copy; us</footer></body></html>"""
    assert text_of(html) == ["Head & tail", "One two three <b> é", "Four", "Five six", "a", "b"]


def test_broken_markup():
    assert text_of("<article><p>a<p>b</div></article") == ["a", "b</article"] or text_of("<article><p>a<p>b") == ["a", "b"]
    assert text_of("<article><p title='it's>x</p></article>") == ["x"]
    assert text_of("<article><p>5 < 6 & 7 &amp;&amp; 8</p>") == ["5 < 6 & 7 && 8"]
    assert text_of("<article><p>cut <script>never closed") == ["cut"]
    assert text_of(None) == text_of("") == [] and text_of("plain text") == ["plain text"]


def test_without_article_the_fullest_slot_and_the_template():
    page = "<body><div class=top><p>Welcome to us</p></div><div id=content><h2>News</h2><p>{}</p><p>tail</p></div></body>"
    assert text_of(page.format("long text " * 9)) == ["News", ("long text " * 9).strip(), "tail"]
    blocks = w.parse(page.format("x"))
    constant = [w.token("text", b.path, b.text) for b in blocks.blocks if b.text in ("Welcome to us", "tail")]
    assert text_of(page.format("long text " * 9), constant) == ["News", ("long text " * 9).strip()]


def test_a_long_list_keeps_its_paragraphs():
    items = "".join(f"<li>a rather long list item {i}</li>" for i in range(20))
    html = f"<body><div class=top><p>Hello</p></div><div id=c><p>{'before ' * 20}</p><ul>{items}</ul><p>{'after ' * 10}</p></div></body>"
    got = text_of(html)
    assert got[0].startswith("before") and got[-1].startswith("after") and len(got) == 22


def page(i, host="h.org", body=None):
    return (i, f"https://{host}/p{i}", "<body><div class=x1><p>Same line everywhere</p><p>Another constant</p><p>Third constant</p></div>"
            f"<div class=x2>{body or ''.join(f'<p>own text {i} {k} and more of it</p>' for k in range(1 + i % 3))}</div></body>")


def test_template_of_a_host(spark):
    rows = [page(i) for i in range(12)] + [page(100 + i, "two.org") for i in range(2)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, id int")
    got = {r.id: r.text for r in w.extract_articles(pages.repartition(3)).collect()}
    for i in range(12):
        assert got[i].split("\n") == [f"own text {i} {k} and more of it" for k in range(1 + i % 3)]
    assert "Same line everywhere" in got[100] or "own text" in got[100]  # two pages make no template
    known = w.deduce_templates(pages.selectExpr("page_id AS page", "'h.org' AS host", "html").where("page < 12")).collect()
    constant = {w.token("text", b.path, b.text) for b in w.parse(rows[0][2]).blocks if "constant" in b.text or "Same" in b.text}
    assert constant <= set(known[0].tokens)


def test_copies_of_an_article_stay(spark):
    html = "<body><nav>Menu</nav><article><h1>One title</h1><p>All pages say this.</p><p>And this.</p></article></body>"
    pages = spark.createDataFrame([(i, "http://c.org/", html) for i in range(20)], "page_id long, url string, html string")
    assert {r.text for r in w.extract_articles(pages).collect()} == {"One title\nAll pages say this.\nAnd this."}


def test_valid_classes_keep_one_order(spark):
    bodies = ["<p>alpha</p><p>beta</p><p>gamma</p>", "<p>beta</p><p>alpha</p><p>gamma</p>"]
    pages = spark.createDataFrame([(i, "h", f"<body><div>{bodies[i % 2]}</div></body>") for i in range(10)], "page long, host string, html string")
    tokens = {t for r in w.deduce_templates(pages).collect() for t in r.tokens}
    own = {w.token("text", b.path, b.text) for b in w.parse(pages.first().html).blocks}
    assert not own & tokens


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "no url", "<article>x</article>"), (2, "http://h/", "")],
                                  "page_id long, url string, html string")
    got = sorted(((r.id, r.url, r.text) for r in w.extract_articles(pages).collect()), key=str)
    assert got == sorted([(1, None, ""), (1, None, ""), (None, "no url", "x"), (2, "http://h/", "")], key=str)
    assert w.extract_articles(pages.limit(0)).count() == 0
    big = "<article>" + "<p>word </p>" * 20_000
    assert len(text_of(big)) == 20_000


def test_copies_count_once_and_layouts_apart(spark):
    plain = "<body><div class=x1><p>{}</p><p>{}</p><p>{}</p></div><div class=x2><p>{}</p></div></body>"
    copies = [(i, "http://c.org/", plain.format("One", "Two", "Three", "the body of the copied page")) for i in range(9)]
    others = [(20 + i, "http://c.org/", plain.format(f"a{i}", f"b{i}", f"c{i}", f"the own body of page {i}")) for i in range(6)]
    layouts = [(100 + i, "http://l.org/", f"<body><div class=m{i % 3}><p>Notice {i % 3}</p><p>Line {i % 3}</p><p>Rule {i % 3}</p></div>"
                f"<div class=b{i % 3}><p>Own words of page {i}, and more of them</p></div></body>") for i in range(24)]
    pages = spark.createDataFrame(copies + others + layouts, "page_id long, url string, html string")
    got = {r.id: r.text for r in w.extract_articles(pages).collect()}
    assert all("the body of the copied page" in got[i] for i in range(9))
    assert all(got[100 + i] == f"Own words of page {i}, and more of them" for i in range(24))
    known = {r.host: set(r.tokens) for r in w.deduce_templates(pages.selectExpr("'l.org' AS host", "html").where("page_id >= 100")).collect()}
    for i in range(3):
        notices = {w.token("text", b.path, b.text) for b in w.parse(layouts[i][2]).blocks if "Own" not in b.text}
        assert notices <= known["l.org"]


def test_the_template_decides_inside_and_against_an_article(spark):
    inside = [(i, "http://i.org/", f"<body><article><p>Follow our site</p><p>Own words of page {i}</p><p>Written by us</p>"
               "<p>All rights kept</p></article></body>") for i in range(8)]
    cards = [(100 + i, "http://k.org/", "<body><div class=x1><p>Same line</p><p>Other line</p><p>Third line</p></div><div id=c>"
              f"<p>{f'long body of page {i} ' * 20}</p></div><article class=card><p>Teaser {i}</p></article></body>") for i in range(8)]
    pages = spark.createDataFrame(inside + cards, "page_id long, url string, html string")
    got = {r.id: r.text for r in w.extract_articles(pages).collect()}
    assert all(got[i] == f"Own words of page {i}" for i in range(8))
    assert all(f"long body of page {i}" in got[100 + i] and "line" not in got[100 + i] for i in range(8))


def test_an_article_in_several_containers(spark):
    parts = [f"section {k} of the text " * 4 for k in range(3)]
    split = "".join(f"<div id=s{k}><p>{t}</p></div>" for k, t in enumerate(parts))
    assert text_of(f"<body><div id=c>{split}</div><div class=top><p>Hello</p></div></body>") == [t.strip() for t in parts]
    titled = "<body><div class=t1><h1>Title</h1></div><div class=b1><p>{}</p></div><div class=x1><p>Hello</p></div></body>"
    assert text_of(titled.format(parts[0])) == ["Title", parts[0].strip()]
    line = "<div class=k1><p>Same line</p><p>Other line</p><p>Third line</p></div>"
    rows = [(i, "http://s.org/", f"<body>{line}<div class=t1><h2>Title {i}</h2></div><div class=b1><p>{f'body of {i} ' * 30}</p></div>"
             f"<div class=e1><p>Short end {i}</p></div><div class=l1><p><a href=x>Go to {i}</a></p></div></body>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in w.extract_articles(pages).collect():
        assert r.text.split("\n") == [f"Title {r.id}", (f"body of {r.id} " * 30).strip(), f"Short end {r.id}"]


def test_text_inside_an_article_stays():
    html = ("<body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> hold</p>"
            "<section id=related-work><h2>Related work</h2><p>Others did.</p></section><p>A <span class=share-price>12 EUR</span> share</p>"
            "<div class=alert-levels><p>Red</p></div><div class=comment-on-results><p>Good.</p></div>"
            "<fieldset><legend>Note</legend><label>Kept</label></fieldset><form><label>Mail</label></form>"
            "<svg><title/><text>Axis</text><path d=x /></svg><desc>drawn</desc><object data=x>Fallback</object>"
            "<div class='read-related-more'><a href=x>Other page</a></div><div class='comments-list'><p>first!</p></div></article></body>")
    assert text_of(html) == ["Let x = 2 hold".replace(" = ", "="), "Related work", "Others did.", "A 12 EUR share", "Red", "Good.",
                             "Note", "Kept", "Axis Fallback"]


def plain_template(htmls, least_pages=5, least_tokens=3, share=0.5):
    """The template's tokens by their definition: whole occurrence vectors, every pair of spans, every page's order."""
    contents = {}
    for h in htmls:
        page = w.parse(h)
        own = tuple(b.text for b in page.blocks if not b.aside)
        contents[own] = min(contents.get(own, (page.tokens, page.places)), (page.tokens, page.places))
    pages = list(contents.values())
    vector, stands = {}, {}
    for k, (tokens, places) in enumerate(pages):
        for p in set(places):
            stands[p] = stands.get(p, 0) + 1
        for t, p in zip(tokens, places):
            at = vector.setdefault((t, p), {})
            at[k] = at.get(k, 0) + 1
    classes = {}
    for (t, p), v in vector.items():
        if len(v) >= least_pages and len(v) >= stands[p] * share:
            classes.setdefault(tuple(sorted(v.items())), set()).add(t)
    classes = {v: ts for v, ts in classes.items() if len(ts) >= least_tokens}
    of = {t: v for v, ts in classes.items() for t in ts}
    bad, orders = set(), {}
    for tokens, _ in pages:
        at = {}
        for i, t in enumerate(tokens):
            if t in of:
                at.setdefault(of[t], []).append(i)
        kept = []
        for v in sorted(at, key=lambda v: (at[v][0], -at[v][-1])):
            a, b = at[v][0], at[v][-1]
            if any(c <= a <= d < b for c, d in kept):
                bad.add(v)
            else:
                kept.append((a, b))
            run = [tokens[i] for i in at[v]]
            once = run[:len(set(run))]
            if run != once * (len(run) // len(once)) or orders.setdefault(v, once) != once:
                bad.add(v)
    return {t for v, ts in classes.items() if v not in bad for t in ts}


def test_templates_equal_the_plain_deduction(spark):
    import random

    rng, rows, by_host = random.Random(12), [], {}
    parts = ["<nav><a>Home</a><a>News</a></nav>", "<div class=top><p>Welcome</p><p>to us</p></div>", "<ul><li>one<li>two<li>three</ul>",
             "<div><p>Same line</p></div>", "<footer><p>Legal</p><p>Imprint</p><p>Contact</p></footer>", "<section><p>A</p><p>B</p></section>"]
    for h in range(8):
        for _ in range(rng.randrange(3, 14)):
            body = [p for p in parts if rng.random() < 0.8]
            rng.shuffle(body) if h % 3 == 0 else None
            body.insert(rng.randrange(len(body) + 1), f"<article><p>{'own ' * rng.randrange(3)}{rng.randrange(9)}</p><p>Same line</p></article>")
            rows.append((len(rows), f"http://h{h}.x/{len(rows)}", "<body>" + "".join(body)))
            by_host.setdefault(f"h{h}.x", []).append(rows[-1][2])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: set(r.tokens) for r in w.deduce_templates(pages.withColumn("host", w.host_of(F.col("url")))).collect()}
    want = {h: t for h, p in by_host.items() if (t := plain_template(p))}
    assert got == want and len(want) > 3


def test_deep_markup_takes_linear_memory():
    import time
    import tracemalloc

    tracemalloc.start()
    began = time.time()
    page = w.parse("<article>" + "<font>" * 200_000 + "<p>x<hr>" * 200 + "</i>" * 100_000)
    assert w.article_blocks(page, set()) == ["x"] * 200
    assert tracemalloc.get_traced_memory()[1] < 500 << 20 and time.time() - began < 60
    tracemalloc.stop()
