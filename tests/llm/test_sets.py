"""Near duplicates, packing, mixing, pages, embeddings, components."""

import random
import tracemalloc
import zlib
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.llm import embeddings, html_model, mixing, packing, queries, simhash
from tillstar.llm.common import components


def test_components(spark):
    rnd = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 30)]
    some = [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    edges = [*chain, *star, *some, (7, 7), (None, 3), (5, None), (1, 0), (0, 1)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    nodes = sorted({n for e in real for n in e})
    reach = brute.groups(nodes, lambda a, b: (a, b) in real or (b, a) in real)
    assert set(got) == set(nodes)
    assert all((got[a] == got[b]) == (b in reach[a]) for a in nodes for b in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query(spark, small, documents):
    expected = brute.near_duplicates([(i, t) for i, t, _ in documents])
    want = {(i, f"{p:016x}", c) for (i, _), (p, c) in expected.items()}
    assert {tuple(r) for r in queries.op5_simhash_popcount(spark, small).collect()} == want


@pytest.mark.parametrize("cell_rows", [1024, 2])
def test_links_of_clusters(spark, cell_rows):
    """Close fingerprints around few centers: all links found, in crowded cells too."""
    rnd = random.Random(cell_rows)
    prints = {0, 1, 2**64 - 1, 2**64 - 2, 1 << 63}
    for _ in range(6):
        center = rnd.getrandbits(64)
        for _ in range(25):
            x = center
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    reach = brute.groups(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    edges = simhash.links(df, "fp", cell_rows=cell_rows).collect()
    if cell_rows > len(prints):
        pairs = {(signed(a), signed(b)) for a in prints for b in prints if signed(a) < signed(b) and (a ^ b).bit_count() <= 4}
        assert {tuple(e) for e in edges} == pairs
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for a in prints:
        for b in prints:
            assert (got.get(signed(a), a) == got.get(signed(b), b)) == (b in reach[a])


def test_crowded_cells_are_cut_by_finer_grids(spark):
    """One half with counters of one, where cells are fullest, the other at random: the finer
    grids alone find every link, and no cell is left for midpoints."""
    rnd = random.Random(8)
    prints = set()
    while len(prints) < 3000:
        low = sum(rnd.choice([1, 2]) << 2 * j for j in range(16))
        x = rnd.getrandbits(32) << 32 | low
        prints.add(x)
        if rnd.random() < 0.2:
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    values = np.array(sorted(prints), np.uint64)
    want = set()
    for k, x in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ x) <= 4):
            pair = sorted((int(x.astype(np.int64)), int(values[k + 1 + j].astype(np.int64))))
            want.add(tuple(pair))
    df = spark.createDataFrame([(int(v.astype(np.int64)),) for v in values], "fp long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(simhash, "_within_two", None)
        assert {tuple(e) for e in simhash.links(df, "fp", cell_rows=100).collect()} == want
    assert len(want) > 300


def test_simhash_on_odd_rows(odd, nothing):
    out = simhash.near_duplicates(odd)
    assert out.count() == odd.count() and simhash.near_duplicates(nothing).count() == 0
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in out.collect()}
    assert by[4, 0] == by[5, 0] == by[6, 0] == by[None, 0] == 4
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    same = [r for r in rows if r["text"] and r["text"].startswith("Every0")]
    assert len(same) == 1 and same[0]["doc_id"] == 1
    assert sum(r["doc_id"] == 1 for r in rows) == 2 and not any(r["doc_id"] is None for r in rows)
    assert simhash.keep_one_of_each(nothing).count() == 0
    alone = odd.where("doc_id is null and text is null")
    assert simhash.keep_one_of_each(alone.union(alone)).count() == 1


def check_packing(rows, size):
    """No gaps, nothing over size; returns the number of sequences and the least possible."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        total += at
    return len(sequences), -(-total // size)


def expected_pieces(text):
    from tokenizers import Tokenizer

    if not hasattr(expected_pieces, "tokenizer"):
        expected_pieces.tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    ids = [*expected_pieces.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    first = len(ids) % 1024 or 1024
    cuts = [0, *range(first, len(ids), 1024), len(ids)]
    return [
        (n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]


def test_packing_query(spark, small, documents):
    rows = queries.op6_exact_complements(spark, small).collect()
    want = sorted((i, *p) for i, t, _ in documents for p in expected_pieces(t))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    used, least = check_packing(rows, 1024)
    assert used <= 1.03 * least + 1


def test_plan_uses_every_piece_once():
    rnd = random.Random(5)
    for _ in range(60):
        size = rnd.choice([7, 40, 128])
        counts = {n: rnd.choice([0, 1, 2, 50]) for n in rnd.sample(range(1, size + 1), rnd.randint(1, min(20, size)))}
        used = defaultdict(int)
        for times, parts in packing.plan(counts, size):
            assert times > 0 and sum(parts) <= size
            for n in parts:
                used[n] += times
        assert dict(used) == {n: c for n, c in counts.items() if c}
    exact = packing.plan({600: 10, 424: 4, 300: 6, 124: 6}, 1024)
    assert sum(t for t, _ in exact) == 10 and all(sum(p) == 1024 for _, p in exact)
    assert packing.plan({}, 10) == []


def test_packing_on_odd_rows(odd, nothing):
    cut = packing.pieces(odd, queries.VOCABULARY, queries.RANKS)
    rows = packing.pack(cut).collect()
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = sorted(((i, *p) for i, t in texts for p in expected_pieces(t)), key=str)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == want
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    check_packing(rows, 1024)
    assert packing.pack(packing.pieces(nothing, queries.VOCABULARY, queries.RANKS)).count() == 0


def test_quick_ids_are_those_of_the_tokenizer():
    rnd = random.Random(8)
    quick, slow = packing._encoder(queries.VOCABULARY, queries.RANKS), packing._encoder(queries.VOCABULARY, None)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "!", "...", "é", "ß", "日本", " ", " ", "\U0001f600", "é", "٣", "<|endoftext|>", "½", "\x00", "\x85", "ǅ", "़"]
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30)))
        assert list(quick(text)) == list(slow(text)), repr(text)
    for text in ("a" * 30_000, " " * 30_000, "12" * 10_000):
        assert list(quick(text)) == list(slow(text))


def test_mixing_query(spark, small, documents):
    rows = queries.op7_entropy_mixing(spark, small).collect()
    sizes = {i: len(brute.WORD.findall(t or "")) for i, t, _ in documents}
    source = {i: s for i, _, s in documents}
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        by[source[r["doc_id"]]].append(r)
    totals = {s: sum(r["size"] for r in own) for s, own in by.items()}
    weights = dict(zip(sorted(totals, key=lambda s: (s is None, s or "")), [5, 2, 1] * 100, strict=False))
    want = mixing.share_out(totals, weights)
    assert sum(want.values()) == pytest.approx(sum(totals.values()))
    for s, own in by.items():
        assert {r["source_size"] for r in own} == {totals[s]} and own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own if r["size"]) / 2
    again = queries.op7_entropy_mixing(spark, small).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_shares_stop_at_three_times():
    got = mixing.share_out({"a": 10, "b": 1000, "c": 0}, {"a": 5, "b": 1, "c": 2})
    assert got == {"a": 30.0, "b": 980.0, "c": 0.0}
    assert mixing.cycled_weights(["b", None, "a", "c", ""]) == {"": 5, "a": 2, "b": 1, "c": 5, None: 2}


def test_newton_meets_two_sets_of_constraints(spark):
    cells = spark.createDataFrame([("a", "x", 100), ("a", "y", 300), ("b", "x", 500), ("b", "y", 50), (None, "x", 40)], "s string, l string, size long")
    by_s, by_l = {"a": 700.0, "b": 200.0, None: 20.0}, {"x": 320.0, "y": 600.0}
    first, second = mixing.balance(cells, [("s", by_s), ("l", by_l)])
    taken = defaultdict(float)
    for r in cells.collect():
        words = r["size"] * np.exp(first[r["s"]] + second[r["l"]])
        taken["s", r["s"]] += words
        taken["l", r["l"]] += words
    assert all(taken["s", k] == pytest.approx(v, rel=1e-6) for k, v in by_s.items())
    assert all(taken["l", k] == pytest.approx(v, rel=1e-6) for k, v in by_l.items())


def test_mixing_on_odd_rows(odd, nothing):
    out = mixing.mix(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r["copies"] <= 3 for r in rows)
    assert all(r["copies"] == 1 for r in rows if r["size"] == 0)
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def article_of(page):
    import html as entities
    import re

    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(p for p in parts if p)


def test_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op8_tree_marginals(spark, sf).collect():
        assert r["text"] == article_of(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


@pytest.fixture(scope="module")
def made():
    return html_model.learn([])


def test_other_layouts(made):
    page = """<html><head><title>x</title><style>p{}</style></head><body><div id="cookie-notice">We use cookies.</div><header><h1>Site</h1></header>
    <div class="menu"><a href=/>Home</a></div><div class="content"><h2>Title &amp; more</h2><p>First para with <a href=x>a link</a> inside
     it.<p>Second &lt;para&gt; a < b.<ul><li>One<li>Two</ul><div class="share">Share this</div><table><tr><td>A<td>B</table></div>
    <div class="sidebar"><h3>Popular</h3><p>Another story here which is long enough to look like text.</p></div>
    <section class="comments"><h3>3 comments</h3><div class="comment"><p>I think this is great. It says what must be said.</p></div></section>
    <form><label>Mail</label><input><button>Go</button></form><script>var a = "<p>no</p>";</script><footer>&copy; 2020</footer></body></html>"""
    assert html_model.extract(page, made).split("\n") == ["Title & more", "First para with a link inside it.", "Second <para> a < b.", "One", "Two", "A", "B"]
    plain = "<p>A page of nothing but a paragraph.<p>And another one with more words in it, so that it should be text."
    assert html_model.extract(plain, made).count("\n") == 1
    assert html_model.extract("<main><h1>T</h1><p>Body text.</p><div id='comments'><p>nice</p></div></main><nav><a>x</a></nav>", made) == "T\nBody text."


def test_unclosed_quotes_end_at_the_next_bracket(made):
    page = "<article><h1>T</h1><p class=\"a>First.</p><p>Second.</p><p title='x > y'>Third.</p></article>"
    assert html_model.extract(page, made) == "T\nFirst.\nSecond.\nThird."
    import time

    start = time.time()
    html_model.extract("<article>" + "<p class=\"a>word" * 20_000, made)
    assert time.time() - start < 20


def test_messages_give_exact_marginals(made):
    """Against all labellings of a small tree."""
    import itertools
    import math

    page = html_model.parse("<div class=menu><a>x</a><p>some words</p></div><article><p>text <b>more</b></p></article>")
    seen = html_model.observations(page)
    weights = {}
    for labels in itertools.product((0, 1), repeat=len(page.tags)):
        total = made.root * labels[0]
        for i, y in enumerate(labels):
            total += y * sum(made.odds.get(f, 0.0) for f in seen[i])
            if i:
                p = made.below[html_model.kind_of(page.tags[i])][labels[page.parents[i]]]
                total += math.log(p if y else 1 - p)
        weights[labels] = math.exp(total)
    odds = made.marginals(page)
    for i in range(len(page.tags)):
        one, none = (sum(w for labels, w in weights.items() if labels[i] == y) for y in (1, 0))
        assert odds[i] == pytest.approx(math.log(one / none), abs=1e-6)


def test_pages_on_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "no markup at all"), (4, "<"), (5, "<p"), (6, "<!-- never closed <p>x"), (7, "</p></div>"), (8, "<script>a"), (8, "<script>a"),
        (9, "<div>" * 3000 + "deep"), (None, "<article><p>a &amp; b&nbsp;c</p></article>"), (10, "<article>" + "<p>word word</p>" * 20000 + "</article>"), (11, "<a title='>'>x</a><p class=\"a"),
    ]
    df = spark.createDataFrame([(i, h, "own") for i, h in rows], "page_id long, html string, main_text string")
    out, at = html_model.with_main_text(df)
    assert at == "main_text_" and out.columns == [*df.columns, at]
    got = {r["page_id"]: r[at] for r in out.collect()}
    assert got[1] == got[2] == got[8] == "" and got[None] == "a & b c" and got[10].count("\n") == 19999
    assert html_model.with_main_text(df.limit(0))[0].count() == 0


def vectors(seed=0, n=300, d=20):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(25, d))
    rows = []
    for i in range(n):
        v = base[rnd.integers(25)] + rnd.normal(size=d) * rnd.choice([0.0, 0.05, 0.15, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rnd.choice([1.0, 2.0])], int(rnd.integers(3))))
    return rows


def expected_links(rows, cosine=0.98):
    linked = defaultdict(set)
    good = [
        (k, np.array(v, float), label) for k, (_, v, label) in enumerate(rows)
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    for i, (a, x, l) in enumerate(good):
        for b, y, m in good[i + 1 :]:
            if l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                linked[a].add(b)
                linked[b].add(a)
    reach = brute.groups(list(range(len(rows))), lambda a, b: b in linked[a])
    ids = lambda k: min((rows[j][0] for j in reach[k] if rows[j][0] is not None), default=None)
    return sorted([(rows[k][0], len(linked[k]), ids(k)) for k in range(len(rows))], key=str)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_all_links_are_found(spark, kind):
    rows = vectors()
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    # Small lists and blocks: probes of several lists, several blocks a list.
    out = embeddings.near_duplicates(df, per_list=30, members=7, queries=11, sample=120)
    got = sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()], key=str)
    assert got == expected_links(rows)
    assert sum(n for _, n, _ in got) > 500


def test_embeddings_on_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (5, v, 1), (5, v, 1), (3, [2.0, 4.0, 6.0], 1), (9, v, 2), (8, v, None), (7, None, 1), (6, [], 1), (4, [0.0, 0.0, 0.0], 1), (2, [1.0, None, 3.0], 1),
        (1, [1.0, float("nan"), 3.0], 1), (10, [float("inf"), 2.0, 3.0], 1), (None, v, 1), (None, [3.0, -1.0, 0.0], 1), (11, [1.0, 2.0, 3.0, 0.0], 1), (12, [3e38, 6e38 / 2, 3e38], 4),
    ]
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], "vec_id long, embedding array<double>, label int, n_links string, cid string")
    found = embeddings.near_duplicates(df).collect()
    got = sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in found], key=str)
    assert got == expected_links(rows)
    # A row without an id is kept only where nothing that it is linked to has one.
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert sorted(r["kept"] for r in found if r["vec_id"] is None) == [False, True]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_probes_are_sufficient_and_small():
    rnd = np.random.default_rng(3)
    x = embeddings._unit(rnd.normal(size=(600, 768)) + 3 * rnd.normal(size=(600, 1)) * rnd.normal(size=(1, 768)))
    index = embeddings.Index(x[rnd.choice(600, 300, replace=False)].copy(), np.zeros((8, 1, 96)), 0.2)
    at = embeddings._nearest(x, index.centroids)
    tracemalloc.start()
    probed = index.probes(x, at)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20e6  # the distances of 600 x 300 x 768 would be 1.1 GB
    near = np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.2
    for i, j in zip(*np.nonzero(near), strict=True):
        assert probed[i, at[j]] or probed[j, at[i]]


def test_contract_types(spark, small):
    assert dict(queries.op6_exact_complements(spark, small).dtypes)["piece"] == "int"
    assert dict(queries.op1_zstd_bands(spark, small).dtypes)["kept"] == "boolean"


def test_embeddings_agree_with_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = con.execute(queries.ORACLES["op9_product_quantisation"]).fetchall()
    assert sorted(map(tuple, queries.op9_product_quantisation(spark, sf).collect())) == sorted(want)


def test_no_operator_keeps_helper_columns(odd):
    assert simhash.keep_one_of_each(odd).select(F.col("key")).distinct().count() == 1
