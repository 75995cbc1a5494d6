from __future__ import annotations

import pytest

from salescope.llm.html_extract import extract, main_text

BODY = "".join(f"<p>Paragraph number {i}, with some commas, and enough words to count as article text here.</p>" for i in range(4))
WANT = " ".join(f"Paragraph number {i}, with some commas, and enough words to count as article text here." for i in range(4))


def test_article_with_everything_around_it():
    page = (
        "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<div class='cookie-notice'>We use cookies, many cookies, and more of them, every day of the week.</div>"
        f"<article><h1>Title</h1>{BODY}<form><label>Mail</label><input></form><div class='ad'>Buy, now</div></article>"
        "<aside><p>Side text, that is long, and has commas, and goes on and on and on for quite a while.</p></aside>"
        "<section id='comments'><p>First comment, quite long, with commas, and more words than the article.</p></section>"
        "<footer>&copy; x</footer></body></html>"
    )
    assert extract(page) == f"Title {WANT}"


def test_div_layout_without_semantic_elements():
    page = (
        "<body><div id='menu'><a href='/a'>A</a> <a href='/b'>B</a></div><div class='wrap'><div class='content'>"
        f"<h2>Head</h2>{BODY}<ul><li>One item</li><li>Two</li></ul></div><div class='sidebar'><p>Other news, here, there.</p></div></div>"
        "<div class='footer'>Imprint</div></body>"
    )
    assert extract(page) == f"Head {WANT} One item Two"


NOISE = (
    "post-comments article-comments entry-comments comment-body comments-content page-sidebar sidebar-content main-menu page-footer cookie-text "
    "content-ad post-share postComments story_comments articleSidebar"
).split()


@pytest.mark.parametrize("name", NOISE)
def test_what_is_named_noise_is_noise(name):
    noise = "<p>Something else, that is quite long, with commas, and more words, than any paragraph has here.</p>" * 6
    assert extract(f"<article><h1>Title</h1>{BODY}<div class='{name}'>{noise}</div></article>") == f"Title {WANT}"
    assert extract(f"<article><h1>Title</h1>{BODY}<section id='{name}'>{noise}</section></article>") == f"Title {WANT}"
    assert extract(f"<body><div class='wrap'><div class='{name}'>{noise}</div><div class='content'>{BODY}</div></div></body>") == WANT


def test_names_that_say_what_lies_beside():
    assert extract(f"<body><div class='content with-sidebar'>{BODY}</div></body>") == WANT
    assert extract(f"<body class='has-left-sidebar'><div id='page' class='no-comments'>{BODY}</div></body>") == WANT
    assert extract(f"<article><div class='entry-header'><h1>Title</h1></div>{BODY}</article>") == f"Title {WANT}"
    assert extract(f"<body><div class='post-notice'>{BODY}</div></body>") == WANT  # nothing else is there


def test_the_whole_article_is_kept():
    lead = "<h1>Title</h1><p>A short lead.</p>"
    assert extract(f"<body><article>{lead}<div class='body'>{BODY * 8}</div><p>End.</p></article></body>") == f"Title A short lead. {' '.join([WANT] * 8)} End."
    short = "<section><h2>Two</h2><p>Short.</p></section><section><p>Three.</p></section>"
    assert extract(f"<body><main><section>{BODY * 6}</section>{short}</main></body>") == f"{' '.join([WANT] * 6)} Two Short. Three."
    comment = "<section id='comments'><article class='comment'><p>I say, this is long, with commas, and with words.</p></article></section>"
    assert extract(f"<main><article>{lead}{BODY}</article>{comment}</main>") == f"Title A short lead. {WANT}"


def test_links_discount_a_container():
    links = "".join(f"<li><a href='/{i}'>A linked headline, with a comma, number {i}, that is quite long indeed</a></li>" for i in range(30))
    assert extract(f"<body><div><ul>{links}</ul></div><div>{BODY}</div></body>") == WANT


def test_markup_faults_and_references():
    assert extract("<article><p>a&nbsp;b &lt;c&gt; &#233;<p>second<b> bold<br>next</article>") == "a b <c> é second bold next"
    assert extract("<p>cut in a refer&am") == "cut in a refer&am"
    assert extract("<article><p>text <a href='x") == "text"
    assert extract("plain text only") == "plain text only"
    assert extract("<table><tr><td>cell one, x</td><td>cell two</td></tr></table>") == "cell one, x cell two"
    assert extract("") == ""
    assert extract("<script>only()</script>") == ""


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "<p>inside, at last</p>" + "</div>" * 3000
    assert extract(deep) == "inside, at last"
    words = "word, " * 200_000
    assert extract(f"<article><p>{words}</p></article>") == words.strip()


def test_frame_edges(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", "kept"), (1, "u", f"<article>{BODY}</article>", "kept"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in main_text(df).collect()), key=repr)
    assert got == sorted([(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0)], key=repr)
    assert main_text(df.limit(0)).count() == 0
