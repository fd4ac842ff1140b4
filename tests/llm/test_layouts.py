"""Main text of pages as common site builders lay them out, by the model of made pages alone."""

import time

import pytest

from tillstar.llm import html_model

A = "The harbour was quiet in the morning, and the boats lay side by side while people came down from the hills to trade wool for salt and bread."
B = "By noon the market was full of voices. An old captain told everyone who would listen how the bay had frozen over when he was a boy."
C = "I liked this a lot, thank you for writing about the harbour and its boats."
LINKS = '<ul><li><a href="/a">Home</a></li><li><a href="/b">Archive</a></li><li><a href="/c">About us</a></li></ul>'

LAYOUTS = {
    "blog with comments": f"""<html><body><header id="masthead"><nav class="main-navigation">{LINKS}</nav></header><div id="primary"><main id="main">
        <article class="post"><h1>Title</h1><p>{A}</p><p>{B}</p></article></main><ol class="commentlist"><li class="comment"><p>{C}</p></li><li class="comment"><p>{C}</p></li></ol>
        </div><div id="secondary"><h3>Archives</h3>{LINKS}</div><footer id="colophon"><p>Powered by something</p></footer></body></html>""",
    "roles": f"""<html><body><div class="topnav"><a href="/a">A</a> <a href="/b">B</a></div><div role="main"><h1>Title</h1><p>{A}</p><p>{B}</p></div>
        <div role="contentinfo"><p>All rights reserved</p></div></body></html>""",
    "old divisions": f"""<html><body><div id="header"><h1>Site name</h1></div><div id="nav">{LINKS}</div><div id="content"><h2>Title</h2><p>{A}</p><p>{B}</p></div>
        <div id="sidebar"><h3>Links</h3>{LINKS}</div><div id="footer">Copyright</div></body></html>""",
    "news": f"""<html><body><nav>{LINKS}</nav><article><h1>Title</h1><p>{A}</p><div class="related-links"><h3>More</h3>{LINKS}</div><p>{B}</p></article>
        <aside class="widget"><p>Buy a boat today, cheaper than ever before.</p></aside><section class="comments"><h3>Comments</h3><p>{C}</p></section></body></html>""",
    "documentation": f"""<html><body><div class="sidebar-wrapper"><nav>{LINKS}</nav></div><main class="content"><h1>Title</h1><p>{A}</p><ul><li>{B}</li></ul></main>
        <footer>Built with care</footer></body></html>""",
    "notices": f"""<html><body><div class="cookie-banner"><p>We use cookies to make this site better for you.</p><button>Accept</button></div><article><h1>Title</h1><p>{A}</p><p>{B}</p></article>
        <form class="newsletter"><p>Sign up for our letters and never miss a thing.</p><input name="mail"></form></body></html>""",
    "discussion": f"""<html><body><header>{LINKS}</header><main><article><h1>Title</h1><p>{A}</p><p>{B}</p></article></main>
        <div id="disqus_thread"><p>{C}</p></div><div class="commentsection"><div class="comment-body"><p>{C}</p></div></div></body></html>""",
    "sidebar first": f"""<html><body><div class="leftbar sidebar"><h3>Menu</h3>{LINKS}<p>Some words about the author of this site and his dog.</p></div>
        <div class="entry-content"><h1>Title</h1><p>{A}</p><p>{B}</p></div></body></html>""",
    "adverts": f"""<html><body><div class="ad-container"><p>Fresh fish at half the price, today only, at the corner shop.</p></div><article><h1>Title</h1><p>{A}</p>
        <div class="advert"><p>Nets of all sizes, mended while you wait.</p></div><p>{B}</p></article></body></html>""",
    "sharing": f"""<html><body><article><h1>Title</h1><p>{A}</p><p>{B}</p><div class="social-share">{LINKS}</div></article><div class="pagination"><a href="/2">Next page</a></div></body></html>""",
}


@pytest.fixture(scope="module")
def model():
    return html_model.learn([])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_main_text_of_layouts(model, layout):
    assert html_model.extract(LAYOUTS[layout], model) == "\n".join(["Title", A, B])


def test_deep_pages_are_linear(model):
    deep = "<div>" * 50_000 + f"<p>{A}</p>" + "</div>" * 50_000
    began = time.process_time()
    assert html_model.parse(deep).tags.count("div") == 50_000
    html_model.extract(deep, model)
    assert time.process_time() - began < 10


def test_labels_of_a_pages_own_markup():
    labels = lambda source: html_model.own_labels(html_model.parse(source))
    assert labels('<div class="user-roles"><p>x</p></div>') is None and labels('<p data-role="main">x</p>') is None
    assert labels("<div role='main'><p>x</p><ol class=commentlist><li>y</ol></div>") == [0, 1, 1, 0, 0]
    assert labels('<main><p class="commentary">x</p></main>') == [0, 1, 1]
