"""Pages where nothing says where the article is."""

import time

from palisade.operators import html

SENTENCE = "The loader, once started, decrypts its payload, writes it to disk and waits for orders from its server. "
LINKS = "".join(f"<li><a href='/{i}'>Another story that is read a lot, number {i}</a></li>" for i in range(30))


def page(*parts):
    return "<html><body>" + "".join(parts) + "</body></html>"


def body(*parts):
    return html.parts(page(*parts))["body"]


def test_an_article_split_over_neighbours_is_joined():
    one, two = f"<div class='c7'><p>First. {SENTENCE * 4}</p></div>", f"<div class='c7'><p>Second. {SENTENCE * 3}</p></div>"
    text = body(f"<div><ul>{LINKS}</ul></div><div>", one, "<div class='x'><img src='a.png'></div>", two, "<p>Last words, in short.</p>", f"</div><div><ul>{LINKS}</ul></div>")
    assert "First." in text and "Second." in text and "Last words" in text and "Another story" not in text


def test_comments_do_not_win_over_the_article():
    """Longer than the article, but named as comments or made of links."""
    remarks = "".join(f"<div class='comment'><p>Remark {i}: {SENTENCE}</p></div>" for i in range(40))
    text = body(f"<div><p>The finding. {SENTENCE * 3}</p><p>{SENTENCE}</p></div>", f"<div id='comments'>{remarks}</div>")
    assert "The finding." in text and "Remark" not in text
    linked = "".join(f"<p><a href='/{i}'>{SENTENCE}</a></p>" for i in range(40))
    text = body(f"<div><p>The finding. {SENTENCE * 3}</p></div>", f"<div>{linked}</div>")
    assert text.startswith("The finding.") and text.count("loader") == 3


def test_names_decide_between_equals():
    block = f"<p>{SENTENCE * 3}</p>"
    text = body(f"<div class='teaser'><p>Teaser. </p>{block}</div>", f"<section><div class='story-text'><p>Story. </p>{block}</div></section>")
    assert "Story." in text and "Teaser." not in text


def test_short_pages_stay_whole():
    assert body("<div><p>Only this.</p></div><div>And that.</div>") == "Only this.\nAnd that."
    assert html.parts(None)["body"] == "" and html.parts("")["links"] == []


def test_a_page_that_takes_too_long_is_given_as_bare_text():
    deep = "<div>" * 3000 + f"<p>{SENTENCE}&amp; so on</p><script>no()</script>" + "</div>" * 3000
    whole = html.parts(page(deep))
    cut = html.parts(page(deep), budget=0.0)
    assert "decrypts" in whole["body"] and cut["body"] == f"{SENTENCE}& so on" and cut["links"] == [] and cut["title"] is None
    began = time.monotonic()
    html.parts(page("<div><p>a, b<a href='x'>c</a></p>" * 20_000), budget=0.2)
    assert time.monotonic() - began < 5
