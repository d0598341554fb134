import time

import pytest

from corpus_texts import prose
from quarry.llm import htmltext
from quarry.llm.htmltext import main_text

BODY = "The house is by the river and it was there for all of us, and the garden was of stone. " * 3
FRAME = """<!DOCTYPE html><html><head><title>T of the page</title><style>p > a {{}}</style></head><body>
<header><a href="/">Home of the site and all that is in it</a></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<script>if (a < b) {{ var t = "</p><p>The of and to in that is it for on with"; }}</script>
<div class="cookie-notice">We use cookies on this site and it is for you to say that it is fine with you.</div>
{}
<aside><p>The most read of the week and all that was in the news of the day for you and us.</p></aside>
<form><label>Name of the one that is to be in the list</label><input name=a><textarea>the of</textarea></form>
<div id="comments"><p>I was there and it was the best of all that I have in my life, and so it is for us.</p></div>
<footer><p>All that is on this site is by the people of the house and it is not for the sale.</p></footer></body></html>"""


def test_article_only():
    page = FRAME.format(f"<article><h1>A short head</h1><p>{BODY}</p><p>Yes.</p><p>{BODY}</p></article>")
    one = BODY.strip()
    assert main_text(page) == f"A short head {one} Yes. {one}"


def test_blocks_without_article_markup():
    page = FRAME.format(f"<div><h2>The head of it</h2><p>{BODY}</p><p>Short one.</p><p>{BODY}</p></div>"
                        "<div><p>Buy it</p></div>")
    one = BODY.strip()
    text = main_text(page)
    assert text.startswith(f"The head of it {one} Short one. {one}")
    assert "cookies" not in text and "best of all" not in text and "for the sale" not in text and "Name of" not in text


def test_link_lists_and_bad_neighbours():
    page = "<ul>" + "".join(f"<li><a href='/{i}'>The of and that is {i}</a></li>" for i in range(9)) + "</ul><p>tiny</p><ul><li><a href=x>all of the more that is</a></li></ul>"
    assert main_text(page + f"<p>{BODY}</p>") == BODY.strip()


def test_short_blocks_inherit():
    blocks = [htmltext.Block("p", False, 0) for _ in range(7)]
    for b, label in zip(blocks, ["bad", "short", "good", "short", "good", "short", "bad"], strict=True):
        b.label, b.text = label, "x"
    htmltext._second_pass(blocks)
    assert [b.label for b in blocks] == ["bad", "bad", "good", "good", "good", "bad", "bad"]


def test_near_good_blocks_lead_short_ones():
    blocks = [htmltext.Block("p", False, 0) for _ in range(4)]
    for b, label in zip(blocks, ["good", "short", "near", "bad"], strict=True):
        b.label, b.text = label, "x"
    htmltext._second_pass(blocks)
    assert [b.label for b in blocks] == ["good", "good", "good", "bad"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   \n ", ""), ("plain words only", "plain words only"), ("a < b & c", "a < b & c"),
    ("<p>x", "x"), ("<script>never closed <p>y", ""), ("<!-- open <p>z</p>", ""),
    (f"<p>{BODY}&amp;&lt;&eacute;&#8217;&nbsp;end</p>", BODY.strip() + " &<é’ end"),
    (f"<p>{BODY.replace(' ', chr(10) + '  ')}</p>", BODY.strip()),
    (f"<article><p><b>{BODY}<br><p>{BODY}</article><footer>&copy; of the site", BODY.strip() + " " + BODY.strip()),
    (f'<p title="a > b">{BODY}</p><p class=ad>{BODY}</p>', BODY.strip()),
])
def test_edges(page, text):
    assert main_text(page) == text


def test_very_long_and_deep_pages():
    assert main_text("<div>" * 3000 + f"<p>{BODY}</p>") == BODY.strip()
    long = "".join(f"<p>{BODY}</p>" for _ in range(3000))
    assert len(main_text(f"<article>{long}</article>")) == 3000 * (len(BODY.strip()) + 1) - 1


def test_other_languages_go_by_length():
    words = " ".join(f"zz{w}" for w in prose(3, 60).split())
    assert main_text(f"<nav><a href=x>zzz</a></nav><p>{words}</p>") == words


def test_a_few_listed_words_do_not_make_a_page_known():
    """Paragraphs of another language in which one listed word turns up."""
    words = prose(3, 60).split()
    parts = [" ".join(f"zz{w}" for w in words[i:] + words[:i]) for i in (0, 7, 20)]
    parts[1] += " sie to a"
    assert main_text("<nav><a href=x>zzz</a></nav>" + "".join(f"<p>{p}</p>" for p in parts)) == " ".join(parts)


def test_links_around_blocks():
    card = f'<a href="/more"><div><h3>Read on about the house</h3><p>{BODY}</p></div></a>'
    assert main_text(f"<article><p>{BODY}</p></article><div>{card}</div>") == BODY.strip()
    assert main_text(f"<div><p>{BODY}</p></div><div>{card}</div>") == BODY.strip()
    # anchors without a target are no links, and an open link ends with the element around it
    assert main_text(f'<a name="top"><p>{BODY}</p><p>{BODY}</p>') == f"{BODY.strip()} {BODY.strip()}"
    assert main_text(f'<div><p><a href="/x">Home</p></div><p>{BODY}</p>') == BODY.strip()


def test_many_unclosed_elements_take_linear_time():
    begin = time.process_time()
    assert main_text("<svg>" * 20_000 + f"<p>{BODY}</p>") == BODY.strip()
    assert time.process_time() - begin < 2


def test_rows(spark):
    rows = [(1, "u", None, "k"), (2, None, f"<p>{BODY}</p>", "k"), (2, None, f"<p>{BODY}</p>", "k"), (None, "v", "x", "k")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in htmltext.extract(table).collect()), key=str)
    one = BODY.strip()
    assert got == sorted([(1, "u", "", 0), (2, None, one, len(one)), (2, None, one, len(one)), (None, "v", "x", 1)], key=str)
    assert htmltext.extract(table.limit(0)).count() == 0


def test_a_batch_of_very_long_pages(spark):
    """Pages of a megabyte each, in one batch: whole texts."""
    pages = [(i, "u", f"<article>{f'<p>{BODY}</p>' * 4500}</article>") for i in range(8)]
    got = htmltext.extract(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)).collect()
    assert [r["n_chars"] for r in sorted(got)] == [4500 * (len(BODY.strip()) + 1) - 1] * 8
