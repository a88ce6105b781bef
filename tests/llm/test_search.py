"""Hard negatives, near-duplicate vectors and ranked lexical search against plain Python versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import odd
import pytest

from caseworks.llm import hyperplanes, lexical, met, negatives

VECTORS = "vec_id bigint, embedding array<double>, label int"


def bag(rows):
    return Counter(tuple(r) for r in rows)


# -- blocks and queries


def test_queries_pass_by_every_block(spark):
    rows = spark.createDataFrame([(i, i % 5) for i in range(100)], "own bigint, block int")
    asked = spark.createDataFrame([(q,) for q in range(30)], "q bigint")

    def search(own, queries):
        total = sum(own["own"].to_pylist())
        for batch in queries:
            yield met.pa.record_batch({"q": batch.column("q"), "total": met.pa.array([total] * batch.num_rows)})

    # Block 5 has no rows; a searcher may stop early.
    got = bag(met.met(rows, asked, 6, search, "q bigint, total bigint").collect())
    assert got == Counter((q, sum(i for i in range(100) if i % 5 == b)) for q in range(30) for b in range(5))
    assert met.met(rows, asked, 6, lambda own, queries: iter(()), "q bigint, total bigint").collect() == []
    assert met.met(odd.empty(rows), asked, 1, search, "q bigint, total bigint").collect() == []


# -- hard negatives


def plain_negatives(rows, positives=5, negatives=10):
    """rows: {vec_id: (label, vector)} of whole numbers."""
    out = set()
    for a, (label, v) in rows.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in rows.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(s, i) for s, i, own in scored if own != label and -30 * ps <= -100 * s <= -90 * ps][:negatives]
            out |= {(a, p, rank, n, -ps, -s) for rank, (s, n) in enumerate(inside, 1)}
    return out


def whole(rows):
    """Rows as the operator reads them: the least (label, vector) of each vec_id."""
    out = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own = ((label + 1) % 10 if i % 7 == 0 else label, [max(-(2**56), min(2**56, math.floor(256 * x))) for x in v])
            out[i] = min(out.get(i, own), own)
    return out


def test_packed_products_are_exact_whatever_the_size():
    draw = random.Random(4)
    for wide, low, high in ((64, -150, 150), (5, 0, 3), (8, 10, 90_000), (16, -(2**31), 2**31), (3, -(2**40), 2**20), (4, -(2**56), 2**56), (1, -1, 0)):
        rows = [[draw.randint(low, high) for _ in range(wide)] for _ in range(77)]
        block = negatives.Packed(np.array(rows, dtype=np.int64))
        for n in (1, 40):  # a later batch may need wider fields, or others than machine words
            asked = [[draw.randint(low, high) // draw.choice([1, 1000]) for _ in range(wide)] for _ in range(n)]
            got = block.scores(np.array(asked, dtype=np.int64))
            assert [[int(x) for x in row] for row in got] == [[sum(a * b for a, b in zip(q, v)) for v in rows] for q in asked]
        assert (block.width <= 31) == (high <= 150), "several candidates share a word where the components are small"


@pytest.mark.parametrize("n_blocks", [1, 5])
def test_hard_negatives_equal_brute_force(spark, n_blocks):
    draw = random.Random(2)
    rows = [(i, [draw.choice([-0.5, 0.1, 0.2, 0.3, 0.31]) for _ in range(8)], draw.choice([0, 1, 1, 1, 2])) for i in range(600)]
    rows += [(i, [0.3] * 8, i % 3) for i in range(600, 700)]  # ties
    rows += [rows[200], rows[200], (300, [0.1] * 8, 9), (400, [0.2], 9), (500, [], 3), (700, [9.5] * 11, 4), (701, [1e5] * 11, 5)]
    rows += [(None, [1.0], 1), (800, None, 1), (801, [1.0], None), (900, [1.0, None], 1), (1000, [math.nan], 1), (1100, [math.inf], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    label = negatives.F.when(negatives.F.col("vec_id") % 7 == 0, (negatives.F.col("label") + 1) % 10).otherwise(negatives.F.col("label"))
    vectors = negatives.whole_vectors(df, label)
    got = negatives.hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"), n_blocks)
    want = plain_negatives(whole(rows))
    assert len(want) > 100 and bag(got.collect()) == Counter(want)
    if n_blocks == 1:
        clashing = df.selectExpr("*", "'v' AS block", "'v' AS vector", "'v' AS rank", "'v' AS _query")
        assert bag(negatives.op11_hard_negatives(clashing).collect()) == Counter(want)


def test_hard_negatives_of_huge_components(spark):
    rows = [(i, [10.0 ** (i % 30), -(2.0**40), 1e300 if i % 11 == 0 else 0.5], i % 2) for i in range(0, 330)]
    got = negatives.op11_hard_negatives(spark.createDataFrame(rows, VECTORS)).collect()
    shown = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    assert bag(got) == Counter((a, p, r, n, shown(x), shown(y)) for a, p, r, n, x, y in plain_negatives(whole(rows)))
    assert got


def test_no_vectors_no_negatives(spark):
    for rows in ([], [(0, [1.0], 1)], [(100, [1.0], 1), (1, [1.0], 2)]):
        assert negatives.op11_hard_negatives(spark.createDataFrame(rows, VECTORS)).collect() == []


# -- near-duplicate vectors


def plain_links(rows, similar=0.98):
    """{(vec_id, label, vector): (n_links, component)} of the distinct valid rows."""
    own = {(i, label, tuple(x + 0.0 for x in v)) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {r: np.array(r[2]) / np.max(np.abs(r[2])) for r in own}
    unit = {r: u / np.linalg.norm(u) for r, u in unit.items()}
    links = {r: [o for o in own if o != r and o[1] == r[1] and len(o[2]) == len(r[2]) and unit[o] @ unit[r] >= similar] for r in own}
    out = {}
    for r in own:
        seen, todo = {r}, [r]
        while todo:
            todo = [o for o in {o for t in todo for o in links[t]} if o not in seen]
            seen.update(todo)
        out[r] = len(links[r]), min(o[0] for o in seen)
    return out


def clusters(draw, n, wide, noise):
    """Groups of like vectors of very different sizes, the last one a third of all rows."""
    rows, number = [], 0
    for size in (1, 2, 3, 5, 8, 30, n):
        for label in (0, 1):
            base = [draw.gauss(0, 1) for _ in range(wide)]
            for _ in range(size):
                rows.append((number, [x + draw.gauss(0, noise) for x in base], label))
                number += 1
    return rows


def test_near_vectors_equal_brute_force(spark):
    draw = random.Random(8)
    rows = clusters(draw, 120, 24, 0.08) + [(1000 + i, [draw.gauss(0, 1) for _ in range(24)], i % 4) for i in range(300)]
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(150)]  # copies
    rows += [(3000, [3 * x for x in rows[5][1]], rows[5][2]), (3001, [1e300 * x for x in rows[5][1]], rows[5][2]), (3002, [1e-300 * x for x in rows[5][1]], rows[5][2])]
    rows += [(7, rows[9][1], rows[9][2]), rows[20], rows[20], (3003, rows[5][1][:5], 0), (3004, [-x for x in rows[5][1]], 0)]
    rows += [(3005, [0.0] * 24, 0), (3006, [], 0), (3007, None, 0), (3008, [math.nan, 1.0], 0), (3009, [1.0, None], 0), (3010, [1.0], None), (None, [1.0], 0)]
    rows += [(3011, [1.0, 0.0], 0), (3012, [1.0, -0.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'v' AS class", "'v' AS bucket", "'v' AS keys", "'v' AS root")
    got = hyperplanes.op12_hyperplane_near_dedup(df).collect()
    want = plain_links(rows)
    expected = Counter()
    for i, v, label in rows:
        key = (i, label, tuple(x + 0.0 for x in v)) if v and None not in v else None
        n, component = want.get(key, (0, i))
        expected[i, n, component, i == component] += 1
    assert bag(got) == expected
    assert max(n for n, _ in want.values()) > 150


def test_hot_buckets_are_split_without_loss(spark, monkeypatch):
    """Parts of eight classes: most links lie between parts, small and large groups are compared differently."""
    monkeypatch.setattr(hyperplanes, "PART", 8)
    monkeypatch.setattr(hyperplanes, "PAIRS", 50)
    rows = clusters(random.Random(5), 90, 16, 0.05)
    got = {r.vec_id: (r.n_links, r.component_id) for r in hyperplanes.near_duplicates(spark.createDataFrame(rows, VECTORS), miss=1e-9).collect()}
    assert got == {r[0]: v for r, v in plain_links(rows).items()}


def test_recall_at_the_threshold():
    """Pairs of a similarity just above the least one, the hardest to find."""
    rng = np.random.Generator(np.random.PCG64(3))
    signs, tables = hyperplanes.shape(1 << 20)
    a = rng.standard_normal((4000, 64))
    b = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.9801 * a + math.sqrt(1 - 0.9801**2) * b
    planes = hyperplanes._planes(64, signs, tables)
    met_in = ((a @ planes >= 0) == (c @ planes >= 0)).reshape(len(a), tables, signs).all(axis=2).any(axis=1)
    assert met_in.mean() >= 0.998


def test_no_vectors_no_classes(spark):
    assert hyperplanes.op12_hyperplane_near_dedup(spark.createDataFrame([], VECTORS)).collect() == []
    one = hyperplanes.op12_hyperplane_near_dedup(spark.createDataFrame([(4, [0.5], 1)], VECTORS)).collect()
    assert [tuple(r) for r in one] == [(4, 0, 4, True)]


# -- ranked lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(documents, items, k=50):
    rows = [(doc_id, Counter(plain_terms(text))) for doc_id, text in documents if doc_id is not None]
    rows = [(doc_id, own) for doc_id, own in rows if own]
    n, occurrences = len(rows), sum(own.total() for _, own in rows)
    df = Counter(t for _, own in rows for t in own)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, own in rows:
            m = 50 + 50 * own.total() * n // occurrences
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 20 * m)) for t in wanted if t in own
            )
            scored += [(-score, doc_id)] if score > 0 else []
        out += [(item, rank, doc_id, -s) for rank, (s, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    texts = [(i, " ".join(draw.choices(words, weight, k=draw.randrange(1, 90)))) for i in range(1500)]
    texts += [(2000 + i, texts[3][1]) for i in range(130)]  # copies: ties beyond the last rank
    texts += [(3, "w7 repeated id"), (None, "w1 w2"), (4000, None), (4001, ""), (4002, " .-! "), (4003, odd.LONG + " w399")]
    texts += [(4004, "Éa É w5W5 W5_w5\x00x1 naïve"), (4005, "w0 " * 70_000)]
    items = [(i, " ".join(draw.choices(words, weight, k=draw.randrange(1, 30)))) for i in range(40)]
    items += [(100, texts[3][1]), (101, "éa Éa NAÏVE w5w5"), (102, None), (103, "..."), (104, "unknown"), (None, "w1"), (105, "w398"), (105, "w398 w3 w3")]
    items += [(106, "word5 other5 w399"), (107, " ".join(words))]
    return texts, items


@pytest.mark.parametrize("shard", [2_000_000, 3000])
def test_lexical_search_equals_brute_force(spark, corpus, monkeypatch, shard):
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "WINDOW", 256)
    texts, items = corpus
    documents = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "'v' AS term", "'v' AS block", "'v' AS shard", "'v' AS score")
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'v' AS words", "'v' AS weight")
    got = bag(lexical.op13_lexical_search(documents.repartition(3), asked).collect())
    assert got == plain_ranks(texts, items)


def test_block_maxima_save_most_of_the_lists(corpus):
    """A query whose best documents hold its rare terms: most blocks of its frequent terms stay compressed."""
    draw = random.Random(1)
    shard = lexical._Shard()
    for i in range(60_000):
        shard.add(i, " ".join(["the"] * draw.randrange(1, 3) + ["of"] * draw.randrange(2)) + " x" * draw.randrange(30) + (" rare gem" if i % (100 if i < 8000 else 1000) == 7 else ""))
    n, occurrences = len(shard.doc_ids), sum(shard.sizes)
    rows = lexical.pa.Table.from_batches(list(shard.written(5, n, occurrences)))
    searcher = lexical.Searcher(n, occurrences, 50)
    searcher.add(rows)
    df = {t: own.df for t, own in searcher.lists[5].items()}
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in (b"the", b"of", b"rare", b"gem")}
    scores, found = searcher.search(weights)
    assert len(found) == 50 and all(i % 100 == 7 for i in found.tolist()) and sorted(scores.tolist(), reverse=True) == scores.tolist()
    assert searcher.opened < searcher.blocks / 3


def test_numbers_of_variable_length_return():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**55, 5], dtype=np.int64)
    data, starts = lexical.packed(values)
    assert lexical.unpacked(data).tolist() == values.tolist() and np.diff(starts).tolist() == [1, 1, 1, 2, 2, 3, 5, 8, 1]


def test_empty_tables_rank_nothing(spark, corpus):
    documents = spark.createDataFrame(corpus[0][:5], "doc_id bigint, text string")
    items = spark.createDataFrame(corpus[1], "item_id bigint, text string")
    assert lexical.op13_lexical_search(odd.empty(documents), items).collect() == []
    assert lexical.op13_lexical_search(documents, odd.empty(items)).collect() == []

