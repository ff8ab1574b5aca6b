from reelhouse.llm import html_extract as hx

MENU = '<nav><ul><li><a href="/">Home</a></li><li>News</li></ul></nav>'


def page(body, foot="&copy; all rights"):
    return (
        '<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>'
        f'{MENU}<!-- ad 3 --><div class="ad">Buy {len(body)}</div>{body}<footer>{foot}</footer></body></html>'
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", 0) for i, u, h in rows], "page_id long, url string, html string, text string, host int")


def texts(spark, rows):
    return {r.page_id: r.text for r in hx.extract_pages(frame(spark, rows)).collect()}


def test_articles(spark):
    rows = [
        (1, "http://a.org/1", page("<article><h1>One &amp; two</h1><p><b>Bold\n  text.<br><p>Next</p></article>")),
        (2, "https://A.org:80/2", page("<article><header><h1>Head</h1></header><p>foo<b>bar</b>&lt;p&gt;</p><div class='comments'>me too</div></article>")),
        (3, "http://a.org/3", page("<main><article><p>in main</p><aside>side</aside><form>f<input></form></article><article class=comment>c</article></main>")),
        (4, "http://a.org/4", "<article><p>never closed <b>at all"),
        (5, None, None),
        (6, "nonsense", ""),
        (7, "http://b.org", "just text, <i>no</i> tags"),
        (8, "http://b.org", "<p>a < b <p>x<li>y</b></p> <script>if (a<b) {</script>z"),
    ]
    got = texts(spark, rows)
    assert got[1] == "One & two Bold text. Next"
    assert got[2] == "Head foobar<p>"
    assert got[3] == "in main"
    assert got[4] == "never closed at all"
    assert got[5] == "" and got[6] == ""
    assert got[7] == "just text, no tags"
    assert got[8] == "a < b x y z"


def test_wrapper_of_a_host_drops_constant_nodes(spark):
    body = lambda i: f'<div class="top">Welcome to our site</div><div class="story"><p>Story {i}</p><p>more {i * 7}</p></div><div class="end">Call us now</div>'
    rows = [(i, f"http://w.org/{i}", f"<html><body>{body(i)}</body></html>") for i in range(12)]
    rows += [(90, "http://w.org/x", f"<html><body>{body(90)}<div class='extra'>own</div></body></html>")]
    rows += [(91, "http://other.org/x", f"<html><body>{body(91)}</body></html>")]
    got = texts(spark, rows)
    assert all(got[i] == f"Story {i} more {i * 7}" for i in range(12))
    assert got[90] == "Story 90 more 630 own"
    assert got[91] == "Welcome to our site Story 91 more 637 Call us now"  # one page: no wrapper yet


def test_copies_of_a_page_keep_their_article(spark):
    rows = [(i, "http://c.org/1", page("<article><h1>Same</h1><p>again</p></article>")) for i in range(20)]
    rows += [(50 + i, "http://c.org/2", page(f"<article><h1>Same</h1><p>again</p></article>", f"v{i}")) for i in range(5)]
    assert set(texts(spark, rows).values()) == {"Same again"}


def test_words_of_a_class_do_not_hide_an_article():
    for name in ("has-sidebar", "with-nav", "legal-news", "share-price"):
        assert hx.extract(f"<div class='{name}'><p>text</p></div>") == "text"
    for name in ("sidebar", "cookie-banner", "site-footer", "x nav"):
        assert hx.extract(f"<div class='{name}'><p>no</p></div><p>text</p>") == "text"
        assert hx.extract(f"<div class='{name}'><article>text</article></div>") == "text"
    assert hx.extract("<form><nav>no</nav><main>text</main></form>") == "text"
    assert hx.extract("<article>text</article><aside><article>teaser</article></aside>") == "text"


CHROME = (
    "comment-list comments-section comment-body user-comments comments-area article-comments post_comments ad-container ad-slot"
    " advert-box promo-box cookie-bar cookie-notice newsletter-box newsletter-signup related-posts share-buttons social-links"
    " widget-area login-form site-header top-nav main-menu sidebar-left sponsored-content"
).split()
TEXT = "has-sidebar with-nav no-comments legal-news share-price content text-block post post-body story left-col section-1 menu-of-the-day header-image-caption".split()


def test_the_head_of_a_class_decides():
    for name in CHROME:
        assert hx.extract(f"<div class='{name}'><p>no</p></div><p>text</p>") == "text", name
        if "header" not in name:  # an article has its own
            assert hx.extract(f"<article><p>text</p><div class='{name}'>no</div></article>") == "text", name
    for name in TEXT:
        assert hx.extract(f"<article><p>a</p><div class='{name}'>text</div></article>") == "a text", name
        assert hx.extract(f"<p>a</p><div class='{name}'>text</div>") == "a text", name


def test_an_article_is_kept_whatever_its_class():
    for name in ("promo", "comment", "sidebar", "ad-slot", "widget"):
        assert hx.extract(f"<nav>no</nav><article class='{name}'>text</article>") == "text"
    assert hx.extract("<article>text</article><article class='comment'>me too</article>") == "text"
    assert hx.extract("<main>text<article class='promo'>buy</article></main>") == "text"


def test_what_is_longer_beside_one_article_changes_nothing(spark):
    links = "".join(f"<a href='/{i}'>Another headline of the day number {i}</a> " for i in range(30))
    remark = "I have read this and think otherwise, at length. " * 20
    assert hx.extract(f"<article>Short story</article><div class='latest'>{links}</div>") == "Short story"
    assert hx.extract(f"<article>Short story</article><section>{remark}</section>") == "Short story"
    rows = [(i, f"http://s.org/{i}", f"<article><h1>T{i}</h1><p>Story of the day {i}</p></article><section>{remark + str(i) if i == 3 else 'ok'}</section>") for i in range(9)]
    rows += [(20 + i, f"http://l.org/{i}", f"<article>Story {i}</article><div class='latest'>{links}{i}</div>") for i in range(9)]
    got = texts(spark, rows)
    assert all(got[i] == f"T{i} Story of the day {i}" for i in range(9))
    assert all(got[20 + i] == f"Story {i}" for i in range(9))


def test_pages_without_article(spark):
    """The wrapper alone tells menu and text apart: no region, no telling class."""
    body = lambda i: f"<div><a>Home</a><a>About</a></div><div><h2>Title {i}</h2><p>First {i}.</p><p>Second {i * 3}.</p></div><div>Imprint and terms</div>"
    rows = [(i, f"http://n.org/{i}", f"<html><body>{body(i)}<div class='comments'>nice {i}</div></body></html>") for i in range(15)]
    got = texts(spark, rows)
    assert all(got[i] == f"Title {i} First {i}. Second {i * 3}." for i in range(15))


def test_self_closed_svg_and_all_of_main():
    assert hx.extract("<p>a</p><svg/><p>b</p><math /><p>c</p><svg><path/>d</svg><p>e</p>") == "a b c e"
    assert hx.extract("<main><h1>Head</h1><p>lede</p><nav>no</nav><article>one</article><article>two</article></main>") == "Head lede one two"


def test_constant_nodes_go_by_their_text(spark):
    plain = lambda i, x: (i, f"http://p.org/{i}", f"<body><div class='top'>Hello</div><div class='story'>{x}</div><div class='key'>{i}</div></body>")
    got = texts(spark, [plain(i, "Nothing new" if i < 19 else "Real news") for i in range(20)])
    assert got[19] == "Real news 19" and got[3] == "3"
    inner = lambda i: f"<article><h1>T{i}</h1><div class='hint'>Read our terms</div><p>Body {i}</p></article>"
    got = texts(spark, [(i, "http://q.org", f"<body>{inner(i)}</body>") for i in range(12)])
    assert got[5] == "T5 Body 5"
    teaser = lambda i: f"<article>More {i}</article><div class='story'>A long story, number {i}</div>"
    got = texts(spark, [(i, "http://r.org", f"<body>{teaser(i)}</body>") for i in range(12)])
    assert got[5] == "More 5 A long story, number 5"


def stm(a, b):
    """Plain simple tree matching of (label, children) trees: its size."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + stm(x, y))
    return m[-1][-1] + 1


def test_alignment_is_simple_tree_matching():
    import random

    rnd = random.Random(9)

    def tree(depth):
        return (rnd.choice("abc") if depth < 4 else "r", [tree(depth - 1) for _ in range(rnd.randint(0, 3))] if depth else [])

    def shape(t):
        return " ".join([f"{t[0]}/{len(t[1])}", *map(shape, t[1])])

    for _ in range(200):
        a, b = tree(4), tree(4)
        at = hx.align(shape(a), shape(b))
        matched = [x for x in at if x >= 0]
        assert len(matched) == stm(a, b) and matched == sorted(set(matched))
        la, lb = (s.split(" ") for s in (shape(a), shape(b)))
        assert all(la[x].split("/")[0] == lb[i].split("/")[0] for i, x in enumerate(at) if x >= 0)


def test_deep_and_long_pages():
    deep = "<div>" * 5_000 + "core" + "</div>" * 5_000
    assert hx.extract(deep) == "core"
    nodes = hx.preorder(hx.fold(hx.parse(deep)))
    other = hx.shape_of(hx.preorder(hx.fold(hx.parse(deep + "<p>x</p>"))))
    assert max(hx.align(hx.shape_of(nodes), other)) == len(nodes) - 1
    assert hx.extract("<article>" + "<p>w</p>" * 50_000 + "</article>") == " ".join(["w"] * 50_000)
    assert hx.extract('<p a="' * 3_000 + "x").endswith("x")


def test_empty_table(spark):
    assert hx.extract_pages(frame(spark, [])).count() == 0


def test_large_wrappers_join_by_host(spark, monkeypatch):
    monkeypatch.setattr(hx, "BROADCAST_BYTES", -1)
    test_wrapper_of_a_host_drops_constant_nodes(spark)
