"""The operators over documents: odd rows, empty tables, hot groups, and comparison with plain Python versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import brute
import odd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseworks.llm import langid, lines, minhash, mixing, passages, pieces, rules

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_documents(spark):
    return odd.documents(spark).cache()


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def prose(seed, n):
    draw = random.Random(seed)
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


# -- mixing


def test_mix_meets_targets_whatever_the_rows(odd_documents):
    rows = mixing.op1_source_mixing(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert sum(r.source_size for r in {r.source_size: r for r in rows}.values()) > 0
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0) <= (r.taken == 0)


def test_targets_share_all_words_and_stop_at_three_times(spark):
    sized = spark.createDataFrame([("a", 100), ("b", 1), ("c", 1), (None, 50)], "source string, size bigint")
    got = {r.source: r for r in mixing.source_targets(sized).collect()}
    assert [got[s].target for s in ("b", "c")] == [3.0, 3.0]
    # Weights 1 (a) and 1 (NULL) share what the full ones leave.
    assert got["a"].target == got[None].target == (152 - 6) / 2
    assert sum(r.target for r in got.values()) == 152


def test_mix_is_near_its_targets_and_repeatable(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(["w"] * draw.randrange(1, 60)), f"s{i % 3 if i % 3 else 0}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first = mixing.op1_source_mixing(df).collect()
    taken, target = Counter(), {}
    for r in first:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)
    assert Counter(mixing.op1_source_mixing(df.repartition(7)).collect()) == Counter(first)
    mixed = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert all(mixed[r.doc_id] * r.size == r.taken for r in first)


def test_longer_texts_are_likelier_within_a_source(spark):
    rows = [(i, " ".join(["w"] * (20 if i % 2 else 2000)), "a" if i < 2000 else "b") for i in range(2500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.copies_per_row(df).filter("source = 'a'").groupBy("size").avg("copies").collect()
    mean = {r["size"]: r["avg(copies)"] for r in got}
    assert mean[2000] > mean[20]


# -- rules


def test_rules_on_odd_rows(odd_documents):
    got = {r.doc_id: r for r in rules.op7_quality_rules(odd_documents).collect() if r.doc_id is not None}
    for i in (1, 2, 3):
        assert (got[i].n_words, got[i].word_chars, got[i].base_failed, got[i].kept) == (0, 0, True, False)
    assert got[10].n_dup_lines == 6 and got[10].n_repeat_words == 7 and got[10].base_failed
    assert got[12].n_words == 120 and got[12].n_repeat_words == 120
    assert got[14].n_symbols == 3
    judged = rules.judged(odd_documents)
    assert judged.filter("size = 'own value' AND word = 'own value'").count() == odd_documents.count()


def test_rules_name_what_is_broken(spark):
    text = " ".join(f"### word{i}" for i in range(60))
    row = rules.judged(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert {"symbol_ratio", "stop_words"} <= set(row.broken_rules) and not row.kept and not row.base_failed


# -- near duplicates


def test_near_duplicates_on_odd_rows(odd_documents):
    rows = minhash.op3_minhash_near_dedup(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    want = brute.near_duplicates([(i, t) for i, t in pairs(odd_documents) if i is not None])
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    left = minhash.deduplicated(odd_documents)
    assert left.columns == odd_documents.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[9] == 1 and ids[5] == ids[7] == 0 and ids[None] == 2 and ids[1] == ids[2] == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_all_pairs(spark, seed):
    """Chains, stars and short texts around the limit of 75 percent."""
    draw = random.Random(seed)
    texts = []
    for group in range(25):
        base = prose(seed * 1000 + group, draw.choice([4, 6, 9, 14, 30, 60, 120, 400, 700]))
        texts.append(list(base))
        for _ in range(draw.randrange(8)):
            copy = list(draw.choice(texts[-3:]))
            for _ in range(draw.randrange(1 + len(copy) // 25 + 1)):
                copy[draw.randrange(len(copy))] = f"new{draw.randrange(10**6)}"
            texts.append(copy)
    draw.shuffle(texts)
    docs = [(i * 3, " ".join(t)) for i, t in enumerate(texts)]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.near_duplicates(docs)


def test_a_group_without_a_common_middle_is_still_one(spark):
    """A long chain: neighbours are alike, ends are not, and all share buckets with some."""
    base = prose(5, 300)
    docs = []
    for i in range(40):
        docs.append((100 - i, " ".join(base)))
        for k in range(3):
            base[(i * 17 + k * 5) % 300] = f"step{i}x{k}"
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in rows} == {r[1] for r in brute.near_duplicates(docs).values()}


# -- substrings


@pytest.mark.parametrize("kind", ["excerpts", "near copies"])
def test_pairs_of_a_group_grow_with_its_members(spark, monkeypatch, kind):
    """400 documents alike in part: excerpts of one text with endings of their own, or copies with words of their own.
    Few pairs are compared, and no link is lost."""
    draw, base = random.Random(7), [f"b{i}" for i in range(900)]
    rows = []
    for i in range(400):
        if kind == "excerpts":
            start, size = draw.randrange(200), draw.randrange(400, 700)
            own = base[start : start + size] + [f"o{i}x{j}" for j in range(draw.randrange(20, 250))]
        else:
            own = [f"o{i}x{j}" if draw.random() < 0.03 else w for j, w in enumerate(base[:400])]
        rows.append((i, " ".join(own)))
    compared, counts = minhash.compared, []

    def counted(pairs, documents):
        counts.append(pairs.count())
        return compared(pairs, documents)

    monkeypatch.setattr(minhash, "compared", counted)
    got = minhash.op3_minhash_near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows)
    assert sum(counts) < 2500, counts


def test_members_show_no_more_than_their_differences(spark, monkeypatch):
    """Copies of one text of many sizes, each with a share of its own of a common stock of words: what their members show
    in a star is part of their differences to its centre, however many kinds of partners there are."""
    draw, rows = random.Random(7), []
    for i in range(240):
        share, size = draw.uniform(0.03, 0.12), draw.randrange(230, 300)
        rows.append((i, " ".join(f"b{j}or" if draw.random() < share else f"b{j}" for j in range(size))))
    pairs, settled, made = minhash._possible_pairs, minhash.settled, []

    def counted(df):
        kept = settled(df)
        made.append(kept.count())
        return kept

    def watched(*args):
        with monkeypatch.context() as inside:
            inside.setattr(minhash, "settled", counted)
            return settled(pairs(*args))

    monkeypatch.setattr(minhash, "_possible_pairs", watched)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows)
    differences, *others = made
    assert max(others) < differences, made


def test_substrings_on_odd_rows(odd_documents):
    rows = passages.op8_substring_dedup(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    want = brute.substring_dedup([(i, t) for i, t in pairs(odd_documents) if i is not None])
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]


def test_substrings_with_hot_passages(spark):
    draw = random.Random(8)
    docs = []
    for i in range(120):
        own = prose(i, draw.randrange(20, 150))
        if i % 3 == 0:
            own += odd.PASSAGE.split()[: draw.randrange(45, 60)] + prose(1000 + i, 10)
        if i % 10 == 0 and docs:
            own = list(docs[draw.randrange(len(docs))][1].split())
        docs.append((i, " ".join(own)))
    rows = passages.deduplicated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute.substring_dedup(docs)


def test_the_sketch_follows_the_anchors(spark):
    """Four cells an anchor up to the bound; few single anchors pass, and all repeated ones do."""
    assert [passages.sketch_bits(n) for n in (0, 16, 17, 1000, 10**6, 67_108_864, 10**12)] == [6, 6, 7, 12, 22, 28, 28]
    n = 5000
    rng = random.Random(8)
    single = [rng.getrandbits(63) for _ in range(n)]
    twice = [-rng.getrandbits(62) - 1 for _ in range(500)]
    rows = [(i, 0, [a]) for i, a in enumerate(single)] + [(n + i, 0, [a]) for i, a in enumerate(twice + twice)]
    df = spark.createDataFrame(rows, "doc_id bigint, text_key bigint, anchors array<bigint>")
    anchors = df.select(F.explode("anchors").alias("anchor"))
    sketch = spark.sparkContext.broadcast(passages._sketch(anchors, passages.sketch_bits(len(rows))))
    passed = [r.anchor for r in passages._maybe_repeated(df, sketch).collect()]
    assert sorted(a for a in passed if a < 0) == sorted(twice + twice)
    assert sum(a >= 0 for a in passed) < 0.08 * n


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(passages, "SKETCH_BITS", 7)
    docs = [(i, " ".join(prose(i % 4, 70) + prose(100 + i, 30))) for i in range(20)]
    rows = passages.deduplicated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute.substring_dedup(docs)


# -- lines


def test_lines_on_odd_rows(odd_documents):
    got = lines.deduplicated(odd_documents)
    assert set(got.columns) == {*odd_documents.columns, "lines_removed"}
    want = brute.line_dedup([(i, t) for i, t in pairs(odd_documents.dropDuplicates(["doc_id"])) if i is not None])
    rows = got.collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if r.doc_id is not None:
            assert r.text == want[r.doc_id]
    assert next(r for r in rows if r.doc_id == 9).text == "fifth line"
    assert next(r for r in rows if r.doc_id == 10).text == "same\nsame\nsame"


def test_repeated_runs_around_a_very_common_line(spark):
    draw = random.Random(4)
    stock = [f"line {i}" for i in range(12)]
    docs = []
    for i in range(150):
        own = [draw.choice(["common line", "", *stock]) for _ in range(draw.randrange(12))]
        docs.append((i, "\n".join(own)))
    rows = lines.deduplicated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text for r in rows} == brute.line_dedup(docs)


def test_long_repeats_of_one_or_two_lines_are_deleted(spark):
    draw = random.Random(6)
    long = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    stock = [long("a", 50), long("b", 49), long("c", 30), long("d", 20), long("e", 19), "f", ""]
    docs = [
        (1, long("x", 300) + "\n" + long("y", 300)), (2, long("x", 300) + "\n" + long("y", 300)), (3, "own\n " + long("x", 300) + " \nown"),
        (4, f"{stock[1]}\nown"), (5, f"{stock[1]}\nother"), (6, f"{stock[2]}\n{stock[3]}\none"), (7, f"two\n{stock[2]}\n{stock[3]}"),
        (8, f"{stock[2]}\n{stock[4]}\nthree"), (9, f"{stock[2]}\n{stock[4]}\nfour"), (10, long("z", 50) + "\n" + long("z", 50)),
    ]
    docs += [(100 + i, "\n".join(draw.choices(stock, k=draw.randrange(7)))) for i in range(150)]
    rows = {r.doc_id: r.text for r in lines.deduplicated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert rows == brute.line_dedup(docs)
    assert [rows[2], rows[3], rows[7], rows[10]] == ["", "own\nown", "two", long("z", 50)]
    assert [rows[i] == dict(docs)[i] for i in (5, 9)] == [True, True]



# -- language


def test_language_on_odd_rows(odd_documents):
    model = langid.learned(odd_documents)
    rows = langid.identified(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.language.lang, r.language.score, r.language.rejected) == ("und", 0.0, True)
        else:
            assert r.language.lang in model and 0 <= r.language.score <= 1
        assert r["size"] == "own value"


def test_language_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.op5_language_id(docs).collect()
    held = [r for r in got if r.held_out]
    assert 100 < len(held) < 300
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    sure = [r for r in got if not r.rejected]
    assert len(sure) >= 0.98 * len(got)


def test_all_of_a_long_text_counts(spark):
    """The language of most of a text is its own, wherever it stands, and the margin does not fall with length."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = tuple(langid.learned(docs).items())
    held = docs.filter(langid.held_out(langid.F.col("doc_id")) & langid.F.col("lang").isin("en", "fr"))
    texts = {"en": [], "fr": []}
    for r in held.select("doc_id", "lang", langid.letters(langid.F.col("text")).alias("text")).orderBy("doc_id").collect():
        texts[r.lang].append(r.text or "")
    english, french = " ".join(texts["en"]).encode()[:1_000_000], " ".join(texts["fr"]).encode()[:150_000]
    assert len(english) == 1_000_000 and len(french) == 150_000
    for text in (french + b" " + english[:600_000], english[:600_000] + b" " + french, english):
        lang, score = langid.classified(model, text)
        assert lang == "en" and score > 5 * langid.NARROW


def test_languages_are_learned_from_long_texts_too(spark):
    rows = [(i, "the words of this text are many " * 2000, "en") for i in range(20)]
    rows += [(100 + i, "les mots de ce texte sont courts", "fr") for i in range(20)]
    model = langid.learned(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(model) == {"en", "fr"} and len(model["en"]) <= langid.DICTIONARY_BYTES


def test_without_labels_every_text_is_unknown(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert langid.op5_language_id(df).first().lang_pred == "und"


# -- pieces


@pytest.fixture(scope="module")
def known():
    return pieces.vocabulary()


def test_pieces_spell_the_exact_text(odd_documents):
    want = {(r.doc_id, None if r.text is None else hashlib.sha256(r.text.encode()).hexdigest()) for r in odd_documents.collect()}
    rows = pieces.op9_merge_dropout(odd_documents).collect()
    assert {(r.doc_id, r.decoded_sha256) for r in rows} == want and len(rows) == odd_documents.count()
    assert all((r.pieces is None) == (r.n_pieces is None) for r in rows)
    assert next(r for r in rows if r.doc_id == 2).pieces == []


def test_separate_encoding_and_decoding_agree(odd_documents, known):
    apart = pieces.decoded(pieces.encoded(odd_documents, known), known).collect()
    assert Counter((r.doc_id, r.text) for r in apart) == Counter(pairs(odd_documents))
    together = pieces.pieces_and_text(odd_documents).collect()
    assert Counter((r.doc_id, str(r.pieces)) for r in apart) == Counter((r.doc_id, str(r.pieces)) for r in together)


def test_chunks_solved_together_equal_the_agenda(known):
    tool = pieces.Encoder(known, rate=0.2)
    chunks = sorted({c for seed in range(3) for c in tool.chunks.findall("▁" + " ".join(prose(seed, 80)).replace(" ", "▁"))})
    wanted = [(v, c) for v in range(3) for c in [*chunks, "▁interesting", "▁information", "aaaa", "▁"]]
    solved = tool._solve_together(wanted)
    assert [memoryview(ids).cast("i").tolist() for ids in solved] == [tool.pieces_of(c, v) for v, c in wanted]


def test_without_dropout_the_agenda_is_that_of_the_model(known):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    tool = pieces.Encoder(known, rate=0.0)
    for text in ["Hello world", "  two  spaces ", "naïve café 123 (x)", "line\nbreak\n\n", "the " * 50, "日本語 ok \U0001f600"]:
        assert memoryview(tool.encode(text, 1)).cast("i").tolist() == model.encode(text)


def test_dropout_varies_by_document_and_place_and_repeats(known):
    tool = pieces.Encoder(known, rate=0.3)
    text = "interesting information " * 20
    first = memoryview(tool.encode(text, 1)).cast("i").tolist()
    assert memoryview(pieces.Encoder(known, rate=0.3).encode(text, 1)).cast("i").tolist() == first
    assert memoryview(tool.encode(text, 2)).cast("i").tolist() != first
    cuts = {tuple(tool.pieces_of("▁information", v)) for v in range(200)}
    assert len(cuts) > 5 and all(b"".join(known.bytes_of[i] for i in c) == b" information" for c in cuts)
    plain = len(pieces.Encoder(known, rate=0.0).pieces_of("▁information", 0))
    assert len(tool.pieces_of("▁information", 0)) >= plain


def test_every_occurrence_has_its_own_dropout(known):
    """A long word is cut in many ways, as often as its draws say, and like the plain agenda with the same draws."""
    tool = pieces.Encoder(known, rate=0.1)
    n = 4000
    ids = memoryview(tool.encode(" ".join(["internationalization"] * n), 1)).cast("i").tolist()
    starts = [i for i, piece in enumerate(ids) if known.bytes_of[piece].startswith(b" ")]
    cuts = {tuple(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])}
    assert len(starts) == n and len(cuts) > 20
    chunks = ["▁internationalization"] * n
    keys = pieces.mix(pieces.np.arange(n, dtype=pieces.np.uint64))
    tool._resolved(["▁internationalization"] * 100, keys[-100:])
    results, _ = tool._resolved(chunks, keys)
    got = [tuple(tool.ids[tool.start[r] : tool.start[r] + tool.count[r]].tolist()) for r in results]
    plain = tuple(pieces.Encoder(known, rate=0.0).pieces_of(chunks[0], 0))
    steps = int(tool.steps[tool.roots[chunks[0]]])
    assert len(set(got)) > 20
    # An occurrence takes the plain steps unless one of them is skipped.
    untouched = (results == tool.roots[chunks[0]]).mean()
    assert abs(untouched - 0.9**steps) < 0.04 and got.count(plain) >= untouched * n
    assert got[:300] == [tuple(tool.pieces_of(chunks[0], int(k))) for k in keys[:300]]


def test_dropout_of_odd_and_long_chunks_follows_the_agenda(known):
    tool = pieces.Encoder(known, rate=0.3)
    chunks = ["▁a͸b", "▁😀information", "▁" + "information" * 3, "▁" + "information" * 9, pieces.LITERAL_META * 2, "▁the"] * 20
    keys = pieces.mix(pieces.np.arange(len(chunks), dtype=pieces.np.uint64) + pieces.np.uint64(7))
    results, _ = tool._resolved(chunks, keys)
    got = [tool.ids[tool.start[r] : tool.start[r] + tool.count[r]].tolist() for r in results]
    assert got == [tool.pieces_of(c, int(k)) for c, k in zip(chunks, keys)]
    many = {memoryview(tool.encode("information " * 3 + "information" * 3, k)).cast("i").tobytes() for k in range(50)}
    assert len(many) > 40


def test_a_full_table_of_results_changes_nothing(known, monkeypatch):
    texts = [" ".join(prose(seed, 60)) for seed in range(30)]
    want = pieces.Encoder(known).encode_all(texts, list(range(30)))
    monkeypatch.setattr(pieces, "REMEMBERED", 0)
    monkeypatch.setattr(pieces, "BATCH_CHARS", 100)
    assert pieces.Encoder(known).encode_all(texts, list(range(30))) == want


# -- all


def test_empty_tables(spark):
    none = odd.empty(odd.documents(spark))
    for build in (
        mixing.op1_source_mixing, minhash.op3_minhash_near_dedup, langid.op5_language_id, lines.op6_line_dedup,
        rules.op7_quality_rules, passages.op8_substring_dedup, pieces.op9_merge_dropout, minhash.deduplicated, mixing.mixed,
    ):
        assert build(none).collect() == []


def test_pipeline_stages_follow_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF_DIR).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    assert all(t.columns == docs.columns for t in tables[:-1])
    start, spoken, lined, single, mixed, final = [t.collect() for t in tables]
    assert {r.doc_id for r in start} > {r.doc_id for r in spoken} and len(spoken) > 0.97 * len(start)
    want = brute.line_dedup([(r.doc_id, r.text) for r in spoken])
    before = {r.doc_id: r.text for r in spoken}
    assert {r.doc_id: r.text for r in lined} == {i: t for i, t in want.items() if t or not before[i]}
    groups = brute.near_duplicates([(r.doc_id, r.text) for r in lined])
    assert {r.doc_id for r in single} == {i for i, (_, root) in groups.items() if i == root}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in single}
    texts = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in mixed}
    assert Counter((r.doc_id, r.decoded_sha256) for r in final) == Counter((r.doc_id, texts[r.doc_id]) for r in mixed)
    assert Counter(map(str, corpus_pipeline.run(spark, SF_DIR).collect())) == Counter(map(str, final))


def test_pipeline_keeps_odd_rows_without_failing(spark, tmp_path):
    for case, docs in (("odd", odd.documents(spark)), ("none", odd.empty(odd.documents(spark)))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            if name != "merge_dropout":
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / case / name))
            docs = spark.read.parquet(str(tmp_path / case / name))
