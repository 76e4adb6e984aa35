"""op3: names, wrappers and odd pages."""


def test_names_and_unclosed_elements_do_not_empty_pages():
    from riskmart.llm.html_extract import article_text
    body = "<p>The first paragraph of the story, long enough.</p><p>And the second one ends it.</p>"
    want = "The first paragraph of the story, long enough.\nAnd the second one ends it."
    for around in ("<form action=x>{}</form>", "<div class='layout has-sidebar'>{}</div>", "<div id='with-header'>{}</div>", "<div class='commentary'>{}</div>",
                   "<section class='sidebar'>{}</section>", "<form><article>{}</article></form>", "<div class=sidebar><main>{}</main></div>", "<aside><article>{}</article></aside>",
                   "<svg width=1 />{}", "<svg a='x>y'/>{}<svg><text>no</text></svg>", "<svg-icon name=a>{}</svg-icon>", "<button>{}", "<button>{}<button>no</button>",
                   "<select><option>{}", "<svg><svg><text>no</text></svg><text>no</text></svg>{}<script>no", "<template><p>no</p></template>{}<textarea>no",
                   "<title/>{}", "<body class='has-ads page-with-sidebar'><div class='entry-header'>{}</div>"):
        assert article_text(f"<html><body>{around.format(body)}</body></html>", None) == want, around
    for out in ("<form>Search</form>", "<div class='site-footer'>foot</div>", "<ul class='comment-list'><li>reader</ul>", "<ul class='commentlist'><li>reader</ul>", "<div id=sidebar1>side</div>", "<div class='cookie-banner'>we use</div>",
                "<section id=comments><article><p>" + "reader " * 60 + "</article></section>", "<aside><article>teaser</article></aside>"):
        assert article_text(f"<html><body><article>{body}</article>{out}</body></html>", None) == want, out
    assert article_text("<svg>" * 3000 + "end" + "<button>" * 3000, None) == "end"


def texts_of(spark, pages):
    from riskmart.llm.html_extract import extract_text
    rows = [(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    return [r.text for r in sorted(got.collect(), key=lambda r: r.page_id)]


def test_template_paragraphs_after_many_others(spark):
    for own in (1, 6, 30):
        mine = [[f"own {k} of page {i}" for k in range(own)] for i in range(40)]
        pages = [("a", "<body><div class=text>" + "".join(f"<p>{t}</p>" for t in texts) + "<p>read our terms</p></div></body>") for texts in mine]
        assert texts_of(spark, pages) == ["\n".join(texts) for texts in mine]


def test_copies_are_one_page_and_differing_texts_stay(spark):
    def html(text, notice="All rights"):
        return f"<body><div class=lead>{text}</div><div class=end>{notice}</div></body>"
    assert texts_of(spark, [("copies", html("One text"))] * 6) == ["One text\nAll rights"] * 6
    own = [f"Story {i}" for i in range(12)]
    pages = [("hot", html("Copied"))] * 18 + [("hot", html(t)) for t in own] + [("hot", html("Late", "Other end"))]
    assert texts_of(spark, pages) == ["Copied"] * 18 + own + ["Late\nOther end"]


def test_template_inside_articles(spark):
    def html(i, tag):
        return (f"<body><{tag}><h1>Title {i}</h1><div>Published by us</div><p>Story {i} begins.</p><p>Story {i} ends.</p><p>Get our letter</p>"
                f"<ul><li><a href=/1>Read this</a></li><li><a href=/2>Read that</a></li></ul><p>By <a href=/{i}>Author number {i}</a></p></{tag}></body>")
    n = 20
    pages = [(tag, html(i, tag)) for tag in ("article", "main") for i in range(n)] + [("few", html(i, "article")) for i in range(3)]
    pages += [("near", f"<body><div>Seen {i}</div><article><h1>One</h1><p>The same story</p></article></body>") for i in range(n)]
    got = texts_of(spark, pages)
    assert got[:2 * n] == [f"Title {i}\nStory {i} begins.\nStory {i} ends.\nBy Author number {i}" for i in range(n)] * 2
    assert all("Get our letter" in t and "Published by us" in t for t in got[2 * n:2 * n + 3])
    assert got[2 * n + 3:] == [f"Seen {i}\nOne\nThe same story" for i in range(n)]


def test_pages_of_any_depth_and_width(spark):
    body = "<p>Story {} of the host.</p>"
    deep = ["<div>" * 5000 + body.format(i) + "</div>" * 5000 for i in range(5)]
    wide = ["<body>" + "".join(f"<div class=c{k % 7}><section>part {k} of {i}</section></div>" for k in range(5000)) for i in range(2)]
    uneven = ["<body>" + "".join(f"<div>{'<ul>' * ((k * (i + 3)) % 11)}row {k} {i}</div>" for k in range(5000)) for i in range(2)]
    got = texts_of(spark, [(f"h{j}", page) for j, pages in enumerate((deep, wide, uneven)) for page in pages])
    assert got[:5] == [f"Story {i} of the host." for i in range(5)]
    assert got[5:7] == ["\n".join(f"part {k} of {i}" for k in range(5000)) for i in range(2)]
    assert got[7:] == ["\n".join(f"row {k} {i}" for k in range(5000)) for i in range(2)]


def test_wrappers_survive_packing():
    import random

    from riskmart.llm import html_extract as H
    rng = random.Random(2)

    def made(depth):
        return {"l": rng.choice("ab"), "n": rng.randint(1, 9), "c": [made(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]}

    for _ in range(50):
        tree = made(5)
        assert H.unpacked(H.packed(tree)) == tree
        order = []
        todo = [H.numbered(tree)]
        while todo:
            node = todo.pop()
            order.append(node["i"])
            todo += reversed(node["c"])
        assert order == list(range(H._size(tree)))


def test_template_equals_a_plain_count(spark):
    """Pages of one shape: a text is template where it stands on 60% of the distinct pages, at least 4, or 80% of 8 among paragraphs."""
    import random
    rng = random.Random(4)
    pages = []
    for host in range(6):
        shares = [rng.choice([0.3, 0.5, 0.65, 0.9, 1.0]) for _ in range(6)]
        for i in range(rng.choice([3, 5, 12, 40])):
            slots = [f"common {host} {k}" if rng.random() < shares[k] else f"own {host} {k} {i}" for k in range(6)]
            pages.append((f"h{host}", [f"title {host} {i}", *slots]))

    def html(texts):
        return "<body>" + "".join(f"<div class=s{k}>{t}</div>" if k % 2 else f"<section id=q{k}><p>{t}</p></section>" for k, t in enumerate(texts)) + "</body>"

    want = []
    for host, texts in pages:
        distinct = {tuple(t) for h, t in pages if h == host}
        kept = []
        for k, t in enumerate(texts):
            n, total = sum(d[k] == t for d in distinct), len(distinct)
            strict = k % 2 == 0
            kept += [] if n >= 4 and total >= (8 if strict else 4) and n >= (0.8 if strict else 0.6) * total else [t]
        want.append("\n".join(kept))
    assert texts_of(spark, [(h, html(t)) for h, t in pages]) == want
