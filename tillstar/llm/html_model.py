"""HTML extraction by a tree-structured graphical model.

A page's elements form a tree. Each is content or not; how likely an element's tag, class
words, amount of text and share of links are under either, and how likely a child is
content given its parent, are counted on labelled pages. Sum-product message passing, up
from the leaves and down from the root, gives each element's exact marginal, and the text
directly inside elements that are more likely content than not is the main text.

Labelled pages are of two sorts: pages made here, whose parts are known, and a bounded
sample (`SAMPLE`) of the given pages whose own markup says where the article is.

Character references are decoded; white space inside a block becomes one space; blocks
follow in page order, joined by a line feed. Scripts, styles, comments and the head are
never text. Null and empty pages, and such without main text, give an empty text; broken
markup is read as far as it goes; repeated rows are read each for itself; an empty table
gives an empty one; input columns all stay.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillstar.llm.common import with_text_column

#: Pages of the table that the model learns from, about (twice as many at most), and pages
#: made for it.
SAMPLE = 100
MADE = 1000

#: A comment, a declaration, or a tag up to its end or its first quote.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)[^'\">]*+",
    re.S,
)
OUTSIDE = re.compile(r"[^'\">]*+")
ROLE = re.compile(r"(?<![\w-])role\s*=\s*[\"']?\s*(main|article)\b", re.I)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no markup: up to their end tag, or else to the end of the page.
RAW = frozenset("script style title textarea noscript iframe".split())
#: Elements of other markup, where `/>` ends any element, and those that it ends as in XHTML.
FOREIGN = frozenset(("svg", "math"))
MAY_END = RAW | FOREIGN | frozenset(("head", "object", "select", "template"))
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body html head caption tbody td tfoot th thead tr button legend summary".split())
#: Start tag -> open elements it ends, up to the nearest of the holders.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words in tags, classes, ids and roles that mark what isn't main text.
AROUND = (
    "ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies discussion "
    "footer form gdpr header masthead menu modal nav navbar navigation newsletter notice popup promo promoted related reply replies respond "
    "search share sharing sidebar skip social sponsor sponsored subscribe tags toolbar widget reader paywall alert complementary signup login "
    "button label disqus pagination pager secondary colophon"
).split()
#: What such a word may be written together with.
TOGETHER = re.compile(
    rf"(?P<before>sub|top|main|site|page|side|left|right|bottom|global|mega)?(?P<word>{'|'.join(sorted(AROUND, key=len, reverse=True))})"
    r"(?P<behind>s|list|lists|section|area|box|wrap|wrapper|container|bar|block|inner|holder|thread|body|text|content|item|items|links|row|panel)?"
)
KNOWN = frozenset(AROUND)
INSIDE = "article main content post entry body story text page-content articlebody maincontent prose blog".split()
INLINE, BLOCK, HOLDER = 0, 1, 2
#: What an unseen feature counts as. Most names of what is around the text are rare but
#: speak clearly.
FAINT = 0.05


@dataclass
class Page:
    """Elements in page order, and the runs of text: (element, block, text)."""

    tags: list[str]
    parents: list[int]
    names: list[str]
    runs: list[tuple[int, int, str]]
    #: Elements whose role is that of the main text or an article.
    mains: set[int] = field(default_factory=set)


class Open(list):
    """The open elements, with a count by tag, so that asking for one needs no look at all."""

    def __init__(self, page: Page):
        super().__init__([0])
        self.page, self.count = page, Counter()

    def open(self, element: int) -> None:
        self.append(element)
        self.count[self.page.tags[element]] += 1

    def close(self) -> str:
        """Closes the innermost one; its tag."""
        tag = self.page.tags[self.pop()]
        self.count[tag] -= 1
        return tag

    def has(self, tags) -> bool:
        return any(self.count[t] for t in tags)


def parse(source: str) -> Page:
    page = Page(["#page"], [-1], [""], [])
    open_ = Open(page)
    block = at = 0
    choosing = False
    dead: set[int] = set()

    def text(low: int, high: int) -> None:
        if low < high:
            page.runs.append((open_[-1], block, source[low:high]))

    search, size = TAG.search, len(source)
    while at < size:
        m = search(source, at)
        if not m:
            text(at, size)
            break
        text(at, m.start())
        at = m.end()
        closing, tag = m.group(1, 2)
        if tag is None:
            continue
        high = _tag_end(source, m.end(2), at, dead)
        if high < 0:
            break  # a tag cut off at the end of the page
        attributes = source[m.end(2) : high]
        at = high + 1
        tag = tag.lower()
        if tag in BLOCKS:
            block += 1
        if closing:
            if open_.has((tag,)):
                while open_.close() != tag:
                    pass
            continue
        if tag in CLOSES_P:
            _end(page, open_, {"p"}, {"button", "td", "th", "table", "object"})
            if choosing:  # no text block is inside a choice
                _end(page, open_, {"select"}, {"table", "object"})
                choosing = False
        if tag in ENDS:
            _end(page, open_, *ENDS[tag])
        page.tags.append(tag)
        page.parents.append(open_[-1])
        page.names.append(" ".join(a or b or c for a, b, c in NAMES.findall(attributes)) if "=" in attributes else "")
        if "=" in attributes and ROLE.search(attributes):
            page.mains.add(len(page.tags) - 1)
        if tag == "br":
            page.runs.append((open_[-1], block, " "))
        if tag in VOID or attributes.endswith("/") and (tag in MAY_END or open_.has(FOREIGN)):
            continue
        if tag in RAW or tag == "head":
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            if end or tag != "head":
                at = end.end() if end else size
            continue
        choosing = choosing or tag == "select"
        open_.open(len(page.tags) - 1)
    return page


def _tag_end(source: str, name: int, at: int, dead: set[int]) -> int:
    """Where the bracket is that ends a tag, -1 for none: outside of quotes of any length,
    or the next one where a quote isn't closed. The tag's name ends at `name`; `at` is its
    first quote, its bracket or the end of the page. `dead` gathers the quotes from which
    an unclosed one is reached, so that each is followed once."""
    size = len(source)
    quotes = []
    while at < size and source[at] != ">":
        quotes.append(at)
        close = -1 if at in dead else source.find(source[at], at + 1)
        if close < 0:
            dead.update(quotes)
            return source.find(">", name)
        at = OUTSIDE.match(source, close + 1).end()
    return at if at < size else -1


def _end(page: Page, open_: Open, which: set[str], holders: set[str]) -> None:
    """Closes open elements of `which`, with all inside, up to the nearest holder."""
    if not open_.has(which):
        return
    for k in range(len(open_) - 1, 0, -1):
        tag = page.tags[open_[k]]
        if tag in holders:
            return
        if tag in which:
            while len(open_) > k:
                open_.close()
            if which == {"p"}:
                return


def words_of(name: str) -> list[str]:
    """Words of class, id and role values; camel case is taken apart, and so are words for
    what is around the main text from what they are written together with."""
    out = []
    for word in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()):
        found = TOGETHER.fullmatch(word) if word not in KNOWN else None
        out.append(found["word"] if found else word)
    return out


def kind_of(tag: str) -> int:
    if tag in BLOCKS:
        return BLOCK if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "dt", "dd", "pre", "blockquote", "figcaption") else HOLDER
    return INLINE


def observations(page: Page) -> list[list[str]]:
    """What is seen of each element: names of features."""
    n = len(page.tags)
    own, links = [0] * n, [0] * n
    for element, _, text in page.runs:
        own[element] += len(text.strip())
    total = own[:]
    for i in range(n - 1, 0, -1):
        links[i] = total[i] if page.tags[i] == "a" else links[i]
        total[page.parents[i]] += total[i]
        links[page.parents[i]] += links[i]
    out = []
    for i, tag in enumerate(page.tags):
        share = links[i] / total[i] if total[i] else 0.0
        seen = [f"tag {tag} links {0 if share < 0.2 else 1 if share < 0.6 else 2}", f"size {0 if not total[i] else 1 if total[i] < 40 else 2 if total[i] < 200 else 3}"]
        if page.names[i]:
            seen += [f"name {w}" for w in dict.fromkeys(words_of(page.names[i]))]
        out.append(seen)
    return out


@dataclass(frozen=True)
class Model:
    """Log odds (content to not) of each feature, and per kind of child the chances that it
    is content below a parent that isn't and below one that is."""

    odds: dict[str, float]
    below: tuple[tuple[float, float], ...]
    root: float

    def marginals(self, page: Page) -> list[float]:
        """Log odds that each element is content: messages up, then down."""
        n = len(page.tags)
        up = [sum(self.odds.get(f, 0.0) for f in seen) for seen in observations(page)]
        sent = [0.0] * n
        kinds = [kind_of(t) for t in page.tags]
        for i in range(n - 1, 0, -1):
            p0, p1 = self.below[kinds[i]]
            e = math.exp(max(-30.0, min(30.0, up[i])))
            sent[i] = math.log((p1 * e + 1 - p1) / (p0 * e + 1 - p0))
            up[page.parents[i]] += sent[i]
        whole = up
        whole[0] += self.root
        for i in range(1, n):
            p0, p1 = self.below[kinds[i]]
            e = math.exp(max(-30.0, min(30.0, whole[page.parents[i]] - sent[i])))
            whole[i] += math.log((p1 * e + p0) / ((1 - p1) * e + 1 - p0))
        return whole


def train(labelled: list[tuple[Page, list[int]]]) -> Model:
    """Counts, smoothed, of features under either label and of child under parent."""
    seen = (Counter(), Counter())
    number = [0, 0]
    pairs = Counter()
    for page, labels in labelled:
        for i, features in enumerate(observations(page)):
            y = labels[i]
            number[y] += 1
            seen[y].update(features)
            if i:
                pairs[kind_of(page.tags[i]), labels[page.parents[i]], y] += 1
    rate = lambda f, y: math.log((seen[y][f] + FAINT) / (number[y] + 2 * FAINT))
    odds = {f: rate(f, 1) - rate(f, 0) for f in seen[0] | seen[1]}
    below = tuple(tuple((pairs[k, p, 1] + 1) / (pairs[k, p, 0] + pairs[k, p, 1] + 2) for p in (0, 1)) for k in (INLINE, BLOCK, HOLDER))
    return Model(odds, below, 0.0)


def extract(source: str, model: Model) -> str:
    """The main text of a page."""
    if not source:
        return ""
    page = parse(source)
    odds = model.marginals(page)
    blocks: dict[int, list[str]] = {}
    for element, block, text in page.runs:
        if odds[element] > 0:
            blocks.setdefault(block, []).append(html.unescape(text))
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def own_labels(page: Page) -> list[int] | None:
    """Labels that a page's markup gives away: inside its article or main element, and in
    nothing that is named as something around it. None without such an element."""
    labels, found = [0], False
    hidden = [False]
    for i in range(1, len(page.tags)):
        tag, parent = page.tags[i], page.parents[i]
        named = {"form" if tag == "select" else tag, *words_of(page.names[i])}
        begins = tag in ("article", "main") or i in page.mains
        hidden.append(hidden[parent] or not named.isdisjoint(AROUND))
        labels.append(int((labels[parent] or begins) and not hidden[i]))
        found = found or begins
    return labels if found else None


def made_page(rnd: random.Random) -> tuple[str, set[int]]:
    """A page and the numbers of its elements (in page order; 0 is the page itself) that are
    content."""
    out: list[str] = []
    content: set[int] = set()
    count = 0

    def words(low: int, high: int) -> str:
        return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(low, high)))

    def put(tag: str, inside, good: bool, name: str = "") -> None:
        nonlocal count
        count += 1
        if good:
            content.add(count)
        out.append(f"<{tag}{name}>")
        inside() if callable(inside) else out.append(inside)
        out.append(f"</{tag}>")

    def named(options) -> str:
        word = rnd.choice(options)
        return f' {rnd.choice(["class", "class", "id", "role"])}="{rnd.choice([word, word, f"{word} box", f"site-{word}", f"{word}-wrap"])}"'

    def paragraph(good: bool, low: int = 1, high: int = 90) -> None:
        def inside():
            out.append(words(low, high) + ". ")
            for tag in rnd.sample(["a", "b", "i", "em", "span", "strong", "code", "math", "svg", "object"], rnd.choice([0, 0, 1, 2])):
                inner = {"math": "mi", "svg": "text"}.get(tag)
                put(tag, (lambda i=inner: put(i, words(1, 5), good)) if inner else words(1, 5), good)
                out.append(words(1, 20) + ". ")

        put(rnd.choice(["p", "p", "p", "p", "h2", "h3", "blockquote", "pre", "div"]), inside, good)

    def listing(good: bool, links: bool) -> None:
        whole = not links and rnd.random() < 0.4  # items of paragraphs, as reader comments have them

        def item():
            if links:
                put("a", words(1, 4), good, ' href="/x"')
            elif whole:
                for _ in range(rnd.randint(1, 2)):
                    paragraph(good, 3, 40)
            else:
                out.append(words(1, 25))

        name = named(AROUND) if not good and not links and rnd.random() < 0.7 else ""
        each = named(AROUND) if name and rnd.random() < 0.5 else ""
        put(rnd.choice(["ul", "ul", "ol"]), lambda: [put("li", item, good, each) for _ in range(rnd.randint(2, 8))], good, name)

    def around(place: int) -> None:
        sort = rnd.random()
        tag = rnd.choice(["div", "section", "div", "aside", "nav", "header", "footer", "form"])
        name = named(AROUND) if tag in ("div", "section") or rnd.random() < 0.4 else ""

        def inside():
            if tag == "header" or rnd.random() < 0.1:
                put(rnd.choice(["h1", "h2", "h3"]), words(1, 4), False)
            if sort < 0.3:
                listing(False, True)
            elif sort < 0.45:
                listing(False, False)
            elif sort < 0.55:
                out.append(words(1, 30))
            else:
                for _ in range(rnd.randint(1, 4)):
                    paragraph(False, 1, 60)
            if tag == "form":
                put("label", words(1, 4), False)
                put("select", lambda: [put("option", words(1, 3), False) for _ in range(rnd.randint(1, 5))], False)
                put("button", words(1, 2), False)

        put(tag, inside, False, name)

    def article() -> None:
        if rnd.random() < 0.8:
            put("h1", words(2, 10), True)
        for _ in range(rnd.randint(1, 9)):
            sort = rnd.random()
            if sort < 0.07:
                around(1)
            elif sort < 0.08:
                put("select", lambda: [put("option", words(1, 3), False) for _ in range(rnd.randint(1, 5))], False)
            elif sort < 0.18:
                listing(True, rnd.random() < 0.1)
            elif sort < 0.22:
                put("table", lambda: [put("tr", lambda: [put("td", words(1, 6), True) for _ in range(3)], True) for _ in range(3)], True)
            else:
                paragraph(True)

    def body() -> None:
        for _ in range(rnd.randint(0, 3)):
            around(0)
        sort = rnd.random()
        if sort < 0.55:
            put(rnd.choice(["article", "main"]), article, True, rnd.choice(["", "", named(INSIDE)]))
        elif sort < 0.9:
            put(rnd.choice(["div", "section"]), article, True, named(INSIDE))
        else:
            put("div", article, True)
        for _ in range(rnd.randint(0, 3)):
            around(2)

    sort = rnd.random()
    if sort < 0.08:  # a bare fragment
        content.add(0)
        article()
    elif sort < 0.16:  # all of the body
        put("html", lambda: put("body", article, True), True)
        content.add(0)
    else:
        put("html", lambda: put("body", body, False), False)
    return "".join(out), content


def learn(sources: list[str], made: int = MADE, seed: int = 3) -> Model:
    """The model from pages made here and those of `sources` that label themselves."""
    rnd = random.Random(seed)
    labelled = []
    for _ in range(made):
        source, content = made_page(rnd)
        page = parse(source)
        labelled.append((page, [int(i in content) for i in range(len(page.tags))]))
    for source in sources:
        page = parse(source)
        labels = own_labels(page)
        if labels:
            labelled.append((page, labels))
    return train(labelled)


def sample_pages(df: DataFrame, source: str, most: int = SAMPLE) -> list[str]:
    """About `most` pages, twice as many at most, chosen by their hash."""
    step = max(1, -(-df.count() // most))
    rows = df.select(F.coalesce(F.col(source), F.lit("")).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(step)) == 0)
    return sorted(r["t"] for r in rows.distinct().limit(2 * most).collect())


def with_main_text(df: DataFrame, source: str = "html", model: Model | None = None) -> tuple[DataFrame, str]:
    """`df` with a column of main texts, and its name; the model is learned from a sample
    of `df` unless given."""
    use = model or learn(sample_pages(df, source))
    return with_text_column(df, source, "main_text", StringType(), lambda: lambda pages: [extract(p, use) for p in pages])
