import html as plain
import re

from llm_helpers import read

from pingloom.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) document.write("<p>no</p>");</script></head><body>
<div id="top" class="site-header"><a href=/>Home</a></div><nav><ul><li><a href="/a">Menu entry, first.</a></ul></nav>
<div class="cookie-notice">We use cookies, and more of them.</div><div class="layout has-sidebar"><div class="post">
<h2>The title</h2><p>Some long text, that is here; it goes on &amp; on,
   with marks. And on.<p>Short.</p><ul><li>one item here<li>two</ul>
<form><p>Mail, please, and a name.</p></form><div class="ad-slot">Buy this, now. Cheap, good.</div></div>
<div class="sidebar"><p>Other, stuff. And more text, long enough to score.</p></div></div>
<div id="comments"><article class="comment"><p>I like, it. Much text, here.</p></article></div>
<footer>&copy; someone, somewhere.</footer></body></html>"""


def test_article_without_the_rest():
    assert html.main_text(PAGE).split("\n") == [
        "The title", "Some long text, that is here; it goes on & on, with marks. And on.", "Short.", "one item here", "two",
    ]


def test_given_pages(spark, sf_dir):
    """Their article is an element of that name with headings, paragraphs and line breaks."""
    for row in read(spark, sf_dir, "pages").collect():
        article = row["html"].partition("<article>")[2].partition("</article>")[0]
        parts = [plain.unescape(re.sub("<[^>]*>", "", p)) for p in re.split("</?h1>|</?p>|<br>", article)]
        assert html.main_text(row["html"]) == "\n".join(" ".join(p.split()) for p in parts if p.strip())


def test_broken_markup():
    assert html.main_text("plain &lt;b&gt;\n  text") == "plain <b> text"
    assert html.main_text("<p>cut <b>off <a href='x") == "cut off"
    assert html.main_text("<p>a < b</p></div></p><p>c") == "a < b\nc"
    assert html.main_text('<p title="a > b">x</p>') == "x"
    assert html.main_text("<!-- open") == "" and html.main_text("") == "" and html.main_text(None) == ""
    assert html.main_text("<style>p{}</style><script>never closed <p>x") == ""


def test_path_scores_prefer_long_punctuated_paths():
    found = html.blocks("<div><p>A long sentence, with marks. And more.</p><p>Next one, also long, here.</p></div><span>x</span>")
    scores = html.path_scores(found)
    assert scores[0] > scores[-1] and scores[1] > scores[-1]


def test_frames(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, None), (3, "", "", ""), (4, "v", "<p>" + "long text, here. " * 20_000, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    sizes = sorted((r["page_id"] or 0, r["n_chars"], len(r["text"])) for r in found.collect())
    assert len(sizes) == 5 and all(n == m for _, n, m in sizes) and sizes[0] == (0, 0, 0)
    assert html.extract(pages.limit(0)).count() == 0


LONG = " ".join(3 * ["A long paragraph, with many words in it; it goes on, and on, with marks. It ends here, after some more words."])


def test_ratios_decide_inside_article_and_main():
    box = '<div class="box"><p>Jane Doe writes here.</p></div>'
    teasers = '<section><div class="card">' + "</div><div>".join(f"Teaser {i}" for i in range(8)) + "</div></section>"
    for tag in ("article", "main"):
        page = f"<body><{tag}><h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>one</ul>{box}<p>{LONG}</p>{teasers}</{tag}></body>"
        assert html.main_text(page).split("\n") == ["Title", LONG, "Short.", "one", LONG]


def test_ratios_decide_without_article():
    teasers = "".join(f"<li>Teaser {i}</li>" for i in range(12))
    page = f"<body><ul>{teasers}</ul><div><div><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></div></body>"
    assert html.main_text(page).split("\n") == ["Title", LONG, "Short.", LONG]


def test_names_do_not_decide_inside_the_article():
    for header in ('<header class="entry-header">', '<div class="post-header">', '<div class="header">'):
        end = "</header>" if header.startswith("<header") else "</div>"
        page = f"<body><article>{header}<h1>Title</h1>{end}<p>{LONG}</p></article></body>"
        assert html.main_text(page).split("\n") == ["Title", LONG]
    for part in (f'<section id="related-work"><h2>Related work</h2><p>{LONG}</p></section>',
                 f'<section id="comments-on-method"><h2 id="comments">Related work</h2><p>{LONG}</p></section>',
                 f'<h2>Related work</h2><p class="discussion">{LONG}</p>'):
        page = f"<body><article><h1>Title</h1><p>{LONG}</p>{part}</article></body>"
        assert html.main_text(page).split("\n") == ["Title", LONG, "Related work", LONG]
    page = f"<body><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><section><div>A last word, in a box.</div></section></article></body>"
    assert html.main_text(page).split("\n") == ["Title", LONG, LONG, "A last word, in a box."]


def test_ratios_decide_under_doubtful_names():
    links = "".join(f'<a href="/{i}">Post {i}</a><br>' for i in range(6))
    page = f'<body><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><div class="related">{links}</div></article></body>'
    assert html.main_text(page).split("\n") == ["Title", LONG, LONG]


def test_plain_names_leave_out_everywhere():
    for name in ("comments", "ad", "newsletter-box", "cookie-notice", "share"):
        box = f'<div class="{name}"><h3>Box</h3><p>{LONG}</p></div>'
        for page in (f"<body><article><h1>Title</h1><p>{LONG}</p>{box}</article></body>", f"<body><div><h1>Title</h1><p>{LONG}</p></div>{box}</body>"):
            assert html.main_text(page).split("\n") == ["Title", LONG]


def test_links_inside_the_article_stay():
    page = (
        f'<body><article><h1><a href="/t">Title</a></h1><p>{LONG}</p><p><a href="/x">One link.</a></p><p>{LONG}</p>'
        '<ul><li><a href="/1">First source</a></li><li><a href="/2">Second source</a></li></ul></article></body>'
    )
    assert html.main_text(page).split("\n") == ["Title", LONG, "One link.", LONG, "First source", "Second source"]
    page = f'<body><div><h1><a href="/t">Title</a></h1><p>{LONG}</p><p><a href="/x">One link.</a></p><p>{LONG}</p></div></body>'
    assert html.main_text(page).split("\n") == ["Title", LONG, "One link.", LONG]


def test_linked_text_is_counted_after_decoding():
    (block,) = html.blocks('<p>some text <a href="/">a &amp;\n      b</a></p>')
    assert block.text == "some text a & b" and block.linked == 5
