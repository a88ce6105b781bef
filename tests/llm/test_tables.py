"""Chats, pages and vectors, and every query with check SQL against it."""

from __future__ import annotations

import json
import random
from collections import Counter

import odd
import pytest
from compare import connect
from compare import rows as bag
from pyspark.sql import functions as F

from caseworks.llm import chat, queries, topk, wrapper

SF_DIR = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("name", list(queries.CHECKS))
def test_query_equals_its_check_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = connect(SF_DIR).execute(queries.CHECKS[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(names, cursor.fetchall())


# -- chats


@pytest.fixture(scope="module")
def turns(spark):
    draw = random.Random(6)
    marks = [*chat.CONTROLS, "\\", "[", "<", "]", ">", "/", " ", "\n", "a", "s>", "INST]", "/INST]", "SYS>>"]
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 7)):
            text = "".join(draw.choice(marks) for _ in range(draw.randrange(12)))
            role = draw.choice(["user", "assistant", "assistant", "system", "tool[/ROLE]\\", "", None])
            rows.append((conv, turn, role, draw.choice([text, text, None])))
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (70, 0, "assistant", "x"), (70, 0, "assistant", "x")]
    return rows


def test_examples_are_read_back_exactly(spark, turns):
    df = spark.createDataFrame(turns, TURNS)
    said = {}
    for conv, turn, role, text in sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0)):
        said.setdefault(conv, []).append((role or "", text or ""))
    rows = chat.examples(df).withColumn("turns", chat.read_turns(F.col("text"))).collect()
    seen = Counter()
    for r in sorted(rows, key=lambda r: r.example):
        got = [(t.role, t.text) for t in r.turns]
        assert got == said[r.conv_id][: len(got)]
        masked = r.text[r.loss_start : r.loss_end]
        if got[-1][0] == "assistant":
            assert r.text.endswith(masked + "</s>") and not any(c in masked for c in chat.CONTROLS)
            seen[r.conv_id] += 1
        else:
            assert masked == "" and len(got) == len(said[r.conv_id])
    assert all(seen[c] == sum(role == "assistant" for role, _ in t) for c, t in said.items())
    assert {r.conv_id for r in rows} == set(said)


def test_no_conversations_leave_the_added_one(spark):
    rows = chat.op2_prefix_targets(spark.createDataFrame([], TURNS)).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in rows] == [(-1, 2, 21)]


# -- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul>{menu}</ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<article><h1>{title}</h1>{body}<div class="ad">Buy more</div><form>Mail <input></form></article>
<section id="comments"><p>First!</p></section><aside>Other</aside><footer>&copy; x</footer></body></html>"""


def page(title, *body, menu=3):
    return PAGE.format(title=title, body="".join(body), menu="<li><a href='/x'>m</a></li>" * menu)


def test_only_the_article_is_extracted(spark):
    rows = [
        (1, "https://a.example/1", page("One", "<p>first  &amp;\n second<p><b>third</b> x<br>y", "<ul><li>i<li>j</ul>")),
        (2, "https://a.example/2", page("Two", "<p>only</p>", menu=9)),
        (3, "https://a.example/3", page("Cut", "<p>open <i>end")[: -len("</article>")].split("<div class=\"ad\">Buy more")[0]),
        (4, "HTTP://B.example:80/x", "<body><div class=menu>m</div><div id=main-content><p>no article</p></div><div class=footer>f</div></body>"),
        (5, None, "just text &lt;b&gt; &eacute;"),
        (6, "odd", None),
        (7, "https://a.example/7", ""),
        (8, "https://c.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in wrapper.op4_wrapper_extraction(df).collect()}
    want = {
        1: "One\n\nfirst & second\n\nthird x y\n\ni\n\nj", 2: "Two\n\nonly", 3: "Cut\n\nopen end", 4: "no article",
        5: "just text <b> é", 6: "", 7: "", 8: "deep",
    }
    assert got == {i: (t, len(t)) for i, t in want.items()}
    named = df.selectExpr("*", "'v' AS host", "'v' AS pattern", "'v' AS _at", "'v' AS _host")
    assert wrapper.extracted(named).filter("pattern = 'v' AND _at = 'v'").count() == len(rows)
    assert wrapper.op4_wrapper_extraction(odd.empty(df)).collect() == []


def test_pages_of_one_host_may_differ_in_their_region(spark):
    menu, foot = "<nav>menu</nav>", "<footer>foot</footer>"
    bodies = {
        1: ("<article><p>in article</p></article><p>beside</p>", "in article"),
        2: ("<main><p>in main</p></main><p>beside</p>", "in main"),
        3: ("<div class=content><p>in content</p></div><p>beside</p>", "in content"),
        4: ("<header>head</header><p>plain</p>", "plain"),
        5: ("<main>around <article><p>both</p></article></main>", "around\n\nboth"),
        6: ("", ""),
    }
    for url in ("https://a.example/x", None):
        rows = [(i, url, f"<body>{menu}{body}{foot}</body>") for i, (body, _) in bodies.items()]
        got = wrapper.op4_wrapper_extraction(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
        assert {r.page_id: r.text for r in got} == {i: text for i, (_, text) in bodies.items()}


def test_telling_words_of_longer_names_and_deep_pages(spark):
    deep = lambda inner: "<div>" * 3000 + inner + "</div>" * 3000
    bodies = {
        1: ('<div class="hidden-gem content"><p>gem</p></div><p>beside</p>', "gem"),
        2: ('<div class="social-science">a</div><p class="search-engine-history">b</p><div class="site-footer-inner">c</div>', "a\n\nb"),
        3: (deep("one<nav>menu</nav><aside>side</aside><p>two<p>three"), "one\n\ntwo\n\nthree"),
        4: (deep("<article>deep<footer>foot</footer></article>beside"), "deep"),
        5: ("<main><p>long text</p><article class=teaser><p>teaser</p></article></main><article>below</article>", "long text\n\nteaser"),
        6: ("<article><h1>t</h1>" + "<p>x</p><span>y</span>" * 20_000 + "</article>", "t" + "\n\nx\n\ny" * 20_000),
    }
    for host in ("https://a.example/", None):
        rows = [(i, host and f"{host}{i}", f"<body>{body}</body>") for i, (body, _) in bodies.items()]
        got = wrapper.op4_wrapper_extraction(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
        assert {r.page_id: r.text for r in got} == {i: text for i, (_, text) in bodies.items()}


def test_template_without_telling_names_is_known_by_the_other_pages_of_the_host(spark):
    """Random pages of bare div, p and b elements: what most pages of a host share at one place is left out."""
    draw = random.Random(4)
    shared = {h: [f"{h} part {i}" for i in range(4)] for h in "abcd"}
    pages = []  # page_id, host, blocks as (inner tag or none, text)
    for i in range(120):
        host = draw.choice("aaaabbcd")
        top = [("p", t) for t in shared[host][:2] if draw.random() < 0.95]
        body = [(draw.choice(["", "p", "b"]), f"text {draw.randrange(60)}") for _ in range(draw.randrange(1, 9))]
        foot = [("", t) for t in shared[host][2:] if draw.random() < 0.6]
        pages.append((i, host, top + body + foot))
    pages += [(200 + i, "few", [("p", "menu"), ("p", f"own {i}")]) for i in range(wrapper.FEW_PAGES - 1)]
    pages += [(300 + i, "copies", [("p", "said"), ("p", "twice")]) for i in range(9)]
    pages += [(400 + i, "", [("p", "menu"), ("p", f"own {i}")]) for i in range(wrapper.FEW_PAGES)]

    def place(tag):
        return "p" if tag == "p" else "div"  # b stands in the block of its div

    kinds = {}
    for host in {h for _, h, _ in pages}:
        kinds[host] = {tuple(blocks) for _, h, blocks in pages if h == host}
    want = {}
    for i, host, found in pages:
        kept = []
        for tag, text in found:
            same = sum((place(tag), text) in {(place(t), x) for t, x in blocks} for blocks in kinds[host])
            having = sum(place(tag) in {place(t) for t, _ in blocks} for blocks in kinds[host])
            if same < wrapper.FEW_PAGES or same < wrapper.SHARE * having:
                kept.append(text)
        want[i] = "\n\n".join(kept)
    assert any("part" in text for text in want.values()) and sum("part 0" in text for text in want.values()) == 0
    assert want[200] == "menu\n\nown 0" and want[300] == "said\n\ntwice" and want[400] == "own 0"

    def written(found):
        return "<body>" + "".join(f"<div><{t}>{x}</{t}></div>" if t else f"<div>{x}</div>" for t, x in found) + "</body>"

    rows = [(i, f"http://{host}/{i}" if host else "odd", written(found)) for i, host, found in pages]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for parts in (1, 7):
        assert {r.page_id: r.text for r in wrapper.op4_wrapper_extraction(df.repartition(parts)).collect()} == want
    alone = df.withColumn("url", F.concat(F.lit("http://h"), "page_id"))
    got = {r.page_id: r.text for r in wrapper.op4_wrapper_extraction(alone).collect()}
    assert got == {i: "\n\n".join(x for _, x in found) for i, _, found in pages}


def test_wrappers_of_many_patterns_are_aligned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "EACH", 3)
    rows = [("https://a.example/", "<article>" + "".join(f"<{t}>x</{t}>" for t in tags) + "</article>") for tags in
            (random.Random(i).choices(("p", "h2", "ul", "dl", "table"), k=6) for i in range(40))]
    df = spark.createDataFrame(rows + [("https://b.example/", "<p>x</p>")], "url string, html string")
    got = {r.host: wrapper.slots(json.loads(r.pattern)) for r in wrapper.wrappers(df).collect()}
    every = {}
    for _, page in rows:
        every |= wrapper.slots(wrapper.pattern(page))
    assert got["a.example"] == every and len(got) == 2


def test_a_wrapper_has_repeats_and_options():
    one = wrapper.pattern("<article><h1>t</h1><p>a</p><p>b</p><dl><dt>k<dd>v<dt>k<dd>v</dl></article>")
    two = wrapper.pattern("<article><h1>t</h1><p><b>a</b></p><img><table><tr><td>1</table></article>")
    both = wrapper.joined(one, two)
    article = both["0:0"][3][0]
    kinds = {node[0]: node for node in article[3]}
    assert kinds["p"][1] and not kinds["p"][2] and kinds["dl"][2] and kinds["table"][2]
    assert kinds["dl"][3][0][0] == "~" and kinds["dl"][3][0][1]
    again = wrapper.joined(both, one)
    assert wrapper.slots(again) == wrapper.slots(both)


# -- vectors


def test_top_k_equals_brute_force_with_ties_and_odd_rows(spark):
    draw = random.Random(9)
    rows = [(i, [draw.choice([-0.5, -0.25, 0.0, 0.1, 0.3]) for _ in range(8)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 500)]  # equal vectors
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")]), (650, [float("inf"), 1.0]), (None, [1.0]), (700, []), (701, [2.0]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, block int")
    whole = {}
    plain = [(r.vec_id, r.vector) for r in topk.quantised(df).collect()]
    for q, v in {i: v for i, v in plain if i % 50 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in plain if i != q)
        whole[q] = [(rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:5])]
    vectors = topk.quantised(df)
    for n_blocks, n_chunks in ((1, 1), (7, 3)):
        got = {}
        for r in topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, n_blocks, n_chunks).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert {q: sorted(v) for q, v in got.items()} == whole
    assert topk.op10_exact_top_k(odd.empty(df)).collect() == []


def test_few_candidates_give_fewer_ranks(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>")
    assert [(r.query_id, r.vec_id, r.score) for r in topk.op10_exact_top_k(df).collect()] == [(0, 1, 131072)]


def test_top_k_of_large_components_is_exact():
    draw = random.Random(11)
    for wide, large in ((64, 500.0), (64, 3000.0), (8, 1e6)):
        rows = [[int(256 * draw.uniform(-large, large)) for _ in range(wide)] for _ in range(300)]
        rows[7] = [x // 1000 for x in rows[7]]
        index = topk.BlockIndex(topk.np.arange(300), topk.np.array(rows, dtype=topk.np.int64))
        assert all(impact.nbytes + own.nbytes < 10**5 for sides in index.postings for own, impact, most in sides)
        for q in range(0, 300, 10):
            scored = sorted((-sum(a * b for a, b in zip(rows[q], v)), i) for i, v in enumerate(rows) if i != q)[:5]
            ids, scores = index.search(q, topk.np.array(rows[q], dtype=topk.np.int64), 5)
            assert list(zip((-scores).tolist(), ids.tolist())) == scored


def test_top_k_of_components_of_any_size(spark):
    draw = random.Random(12)
    sizes = (0.3, 3e6, 1e9, 1e12, 1e300)
    rows = [(i, [draw.uniform(-1, 1) * draw.choice(sizes) for _ in range(6)]) for i in range(200)]
    rows += [(200 + i, [1e300, -1e300, 1e300]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    plain = {r.vec_id: [max(-(2**56), min(2**56, x)) for x in r.vector] for r in topk.quantised(df).collect()}
    assert plain[200] == [2**56, -(2**56), 2**56]
    whole = []
    for q in (i for i in plain if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(plain[q], v)), i) for i, v in plain.items() if i != q)[:5]
        whole += [(q, rank + 1, i, max(-(2**63) + 1, min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scored)]
    vectors = topk.quantised(df)
    for n_blocks, n_chunks in ((1, 1), (3, 2)):
        got = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, n_blocks, n_chunks)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == sorted(whole)
