"""Pages with markup inside markup."""

import pytest

from tillstar.llm import html_model


@pytest.fixture(scope="module")
def made():
    return html_model.learn([])


LONG = "This is a longer paragraph of the story, with enough words in it to be told from what stands around it."


@pytest.mark.parametrize("tag", ["svg", "math", "select", "object", "template"])
def test_unclosed_elements_lose_nothing(made, tag):
    page = f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>First. {LONG}</p><{tag} width=1><p>Second. {LONG}</p><p>Third. {LONG}</p></article></body></html>"
    assert html_model.extract(page, made).split("\n") == ["Title", f"First. {LONG}", f"Second. {LONG}", f"Third. {LONG}"]


def test_text_in_other_markup(made):
    def text(inside):
        return html_model.extract(f"<body><article><h1>T</h1><p>{LONG}</p>{inside}<p>End. {LONG}</p></article></body>", made).split("\n")[2:-1]

    assert text("<p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> says.</p>") == ["As x=1 says."]
    assert text(f"<object data=a.swf><param name=b><p>{LONG}</p></object>") == [LONG]
    assert text("<p>Pick <svg><svg><path d='M0'/></svg><style>a{}</style><title>t</title><g/></svg>here.</p>") == ["Pick here."]
    assert text("<select><option>Red<option>Green</select>") == []
    assert text("<p>a<script>b</script><iframe>c</iframe>d</p>") == ["ad"]


@pytest.mark.parametrize("quote", ["'", '"'])
@pytest.mark.parametrize("length", [10, 3990, 4010, 500_000])
def test_attributes_of_any_length(made, quote, length):
    value = "<b>LEAKED TEXT</b> " * (length // 19 + 1)
    page = f"<body><article><h1>T</h1><p>{LONG}</p><div data-props={quote}{value}{quote} class=box><p>End. {LONG}</p></div></article></body>"
    assert html_model.extract(page, made) == f"T\n{LONG}\nEnd. {LONG}"


def test_unclosed_quotes(made):
    assert html_model.extract(f"<article><p>{LONG}</p><p title=\"x>End. {LONG}</p></article>", made) == f"{LONG}\nEnd. {LONG}"
    assert html_model.parse("<p>a</p><b title='x").runs == [(1, 1, "a")]
    for part in ('<p "> "', "<p class=\"a>word", "<p '> ' \"x\" "):
        html_model.parse("<article>" + part * 100_000 + "'>")  # each quote is followed once
