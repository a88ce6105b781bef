"""Ranked lexical search: an index of compressed posting blocks per shard of documents, processed by Block-Max MaxScore.

Terms are maximal runs of letters and digits (all characters beyond ASCII count as such), only A-Z lower-cased. A
document's score is the sum over the query's distinct terms of weight times impact, in whole numbers (see ``impact``).

``counted`` finds the number of documents and of their terms, ``indexed`` writes the index: per shard (some documents of
one partition, at most about ``SHARD`` postings) and term the postings in blocks of ``BLOCK``, as gaps and frequencies
of variable length, with each block's last document and largest impact. Texts are read twice and never shuffled. An index
for given queries leaves out lists that none of them reads, by a bit map of 4 MB of the hashes of their terms.

``ranked`` sends the lists of the queries' terms to the searcher of their group of shards, where the queries pass by
(``met``). Lists are ordered by their bound, weight times largest impact. The lists whose bounds together cannot lift a
document over the k-th best score so far are non-essential: candidates come from the other, essential ones only. For
each non-essential list, largest bound first, a candidate survives only if its sum, the largest impact of the block
that would hold it and the bounds of the lists below can still reach the k-th score; of the list only the blocks that
hold a survivor are decompressed. Documents are taken in windows, so that the k-th score rises on the way and moves
further lists out of the essential ones. The k best of each group are merged per query.

Results for odd rows: texts that are NULL or have no term, and rows without doc_id, take no part and are not counted;
repeated rows are documents of their own, each counted and ranked. Queries without id or terms give no rows; rows of
one item_id are one query. Equal scores go to the smaller doc_id. Texts of any length are read whole. Further columns
are left out. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from caseworks.llm.flat_text import buffers
from caseworks.llm.ids import bit_map, has
from caseworks.llm.met import met
from caseworks.llm.support import settled

BLOCK = 128
SHARD = 2_000_000  # postings
PIECE = 1 << 17  # postings that are compressed at once
WINDOW = 4096  # documents of a shard that are searched at once
TOP = 50
SPARK_SEED = 42  # of Spark's xxhash64
SCALE, STEP, FREE, SHARE = 1_000_000_000, 1000, 20, 50  # the fixed numbers of the score
# Bytes that are part of terms stay, with A-Z as a-z; all others become spaces.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INSIDE = np.frombuffer(_TERM, dtype=np.uint8) != 32


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TERM).split()


def impact(tf: np.ndarray, n: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """What a term that occurs ``tf`` times brings to a document of ``n`` terms, without its weight."""
    m = 100 - SHARE + SHARE * n * documents // max(1, occurrences)
    return SCALE * tf // (STEP * tf + FREE * m)


def _rows(documents: DataFrame) -> DataFrame:
    return documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def counted(documents: DataFrame) -> tuple[int, int]:
    """The number of documents with a term, and of all their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            some = total = 0
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                inside = _INSIDE[data[a:b]]
                n = int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(b > a and inside[0])
                some, total = some + (n > 0), total + n
            yield pa.record_batch({"documents": pa.array([some], pa.int64()), "occurrences": pa.array([total], pa.int64())})

    sums = _rows(documents).mapInArrow(run, "documents bigint, occurrences bigint").agg(F.sum("documents"), F.sum("occurrences")).first()
    return sums[0] or 0, sums[1] or 0


# -- blocks of numbers of variable length: seven bits a byte, the last byte of a number below 128


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each value starts."""
    size = np.ones(len(values), dtype=np.int64)
    for bits in range(7, 63, 7):
        size += values >> bits > 0
    starts = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(starts[-1], dtype=np.uint8)
    for b in range(int(size.max(initial=0))):
        own = size > b
        out[starts[:-1][own] + b] = values[own] >> 7 * b & 127 | (size[own] > b + 1) << 7
    return out, starts


def unpacked(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts) if len(data) else np.zeros(0, dtype=np.int64)


# -- the index

INDEX = "shard bigint, term binary, df bigint, last array<int>, most array<int>, place array<int>, data binary, doc_ids array<bigint>, sizes array<bigint>"


class _Shard:
    """Documents in the order they come, until the shard is written."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.doc_ids, self.sizes, self.parts, self.postings = [], [], [], 0

    def add(self, doc_id: int, text: str) -> None:
        own = Counter(terms(text))
        if own:
            self.parts.append((
                np.fromiter(map(self.numbers.__getitem__, own), dtype=np.int32, count=len(own)),
                np.fromiter(own.values(), dtype=np.int32, count=len(own)),
            ))
            self.doc_ids.append(doc_id)
            self.sizes.append(own.total())
            self.postings += len(own)

    def written(self, shard: int, documents: int, occurrences: int, wanted: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """A row per term, or per term that a bit map has, and one row with the documents."""
        doc_ids, sizes = np.array(self.doc_ids, dtype=np.int64), np.array(self.sizes, dtype=np.int64)
        own = np.argsort(doc_ids, kind="stable")  # by doc_id, so that places break ties
        doc_ids, sizes = doc_ids[own], sizes[own]
        number = np.empty(len(own), dtype=np.int32)
        number[own] = np.arange(len(own))
        term = np.concatenate([t for t, _ in self.parts])
        doc = np.repeat(number, [len(t) for t, _ in self.parts])
        tf = np.concatenate([f for _, f in self.parts])
        self.parts.clear()
        names = list(self.numbers)
        if wanted is not None:
            hashes = np.fromiter((xxh64_intdigest(name, SPARK_SEED) for name in names), dtype=np.uint64, count=len(names))
            good = has(wanted, hashes.view(np.int64))
            names = [name for name, own in zip(names, good.tolist()) if own]
            kept = good[term]
            term, doc, tf = (np.cumsum(good) - 1)[term[kept]].astype(np.int32), doc[kept], tf[kept]
        order = np.lexsort((doc, term))
        doc, tf = doc[order], tf[order]
        df = np.bincount(term, minlength=len(names))
        del term, order
        ends = np.cumsum(df)
        a = 0
        while a < len(df):  # some terms at a time
            begin = ends[a] - df[a]
            b = max(a + 1, min(a + 10_000, int(np.searchsorted(ends, begin + PIECE))))
            one = slice(begin, ends[b - 1])
            gain = impact(tf[one].astype(np.int64), sizes[doc[one]], documents, occurrences)
            yield _lists(shard, names[a:b], df[a:b], doc[one].astype(np.int64), tf[one], gain)
            a = b
        rest = {field.name: pa.nulls(1, field.type) for field in _FIELDS}
        rest |= {"shard": pa.array([shard], pa.int64()), "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64()))}
        yield pa.record_batch(rest)


_FIELDS = pa.schema({
    "shard": pa.int64(), "term": pa.binary(), "df": pa.int64(), "last": pa.list_(pa.int32()), "most": pa.list_(pa.int32()),
    "place": pa.list_(pa.int32()), "data": pa.binary(), "doc_ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()),
})


def _lists(shard: int, names: list[bytes], df: np.ndarray, doc: np.ndarray, tf: np.ndarray, gain: np.ndarray) -> pa.RecordBatch:
    """Rows of some terms, whose postings follow one another."""
    first = np.cumsum(df) - df
    gap = doc.copy()
    gap[1:] -= doc[:-1]
    gap[first] = doc[first]
    data, starts = packed(np.stack([gap, tf], axis=1).ravel())
    # Blocks of a term: every BLOCK postings from its first one.
    n_blocks = -(-df // BLOCK)
    ends = np.cumsum(n_blocks)
    block = np.repeat(first, n_blocks) + BLOCK * (np.arange(ends[-1]) - np.repeat(ends - n_blocks, n_blocks))
    until = np.minimum(block + BLOCK, np.repeat(first + df, n_blocks))
    begin = starts[2 * first]
    offsets = pa.array(np.append(0, ends), pa.int32())
    numbers = {"last": doc[until - 1], "most": np.maximum.reduceat(gain, block), "place": starts[2 * block] - np.repeat(begin, n_blocks)}
    bounds = pa.py_buffer(np.append(begin, len(data)).astype(np.int32))
    rows = {"shard": np.full(len(df), shard), "term": pa.array(names, pa.binary()), "df": pa.array(df, pa.int64())}
    rows |= {name: pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32())) for name, values in numbers.items()}
    rows["data"] = pa.Array.from_buffers(pa.binary(), len(df), [None, bounds, pa.py_buffer(data)])
    rows |= {name: pa.nulls(len(df), pa.list_(pa.int64())) for name in ("doc_ids", "sizes")}
    return pa.record_batch(rows)


def indexed(documents: DataFrame, n_documents: int, occurrences: int, wanted: DataFrame | None = None) -> DataFrame:
    """The index: rows of lists (``term`` not NULL), and a row with the documents of each shard. With ``wanted``, a
    column of term hashes, other lists are left out."""
    spark = documents.sparkSession
    bits = None if wanted is None else spark.sparkContext.broadcast(bit_map(wanted, wanted.columns[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = _Shard(), TaskContext.get().partitionId() << 32
        own = None if bits is None else bits.value
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                shard.add(doc_id, text.as_py())
                if shard.postings >= SHARD:
                    yield from shard.written(number, n_documents, occurrences, own)
                    shard, number = _Shard(), number + 1
        if shard.postings:
            yield from shard.written(number, n_documents, occurrences, own)

    return _rows(documents).mapInArrow(run, INDEX)


# -- the search


class _List:
    """A term's postings in one shard."""

    def __init__(self, last: np.ndarray, most: np.ndarray, place: np.ndarray, data: memoryview, df: int):
        self.last, self.most, self.df = last, most, df
        self.data = np.frombuffer(data, dtype=np.uint8)
        self.place = np.append(place, len(self.data))
        self.bound = int(most.max())

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of some blocks, decompressed."""
        runs = np.flatnonzero(np.diff(blocks, prepend=-2) != 1)
        ends = np.append(runs[1:], len(blocks))
        data = [self.data[self.place[blocks[a]] : self.place[blocks[b - 1] + 1]] for a, b in zip(runs, ends)]
        pairs = unpacked(data[0] if len(data) == 1 else np.concatenate(data)).reshape(-1, 2)
        size = np.where(blocks == len(self.last) - 1, self.df - BLOCK * (len(self.last) - 1), BLOCK)
        begin = np.cumsum(size) - size
        doc = np.cumsum(pairs[:, 0])
        # Gaps count from the last document of the block before.
        before = np.where(blocks > 0, self.last[blocks - 1], 0)
        return doc + np.repeat(before - doc[begin] + pairs[begin, 0], size), pairs[:, 1]


class Searcher:
    """The shards of one group, searched one after another with the k-th score carried on."""

    def __init__(self, n_documents: int, occurrences: int, k: int):
        self.totals, self.k = (n_documents, occurrences), k
        self.docs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.lists: defaultdict[int, dict[bytes, _List]] = defaultdict(dict)
        self.opened = self.blocks = 0

    def add(self, rows: pa.Table) -> None:
        for batch in rows.to_batches():
            columns = {name: batch.column(name) for name in ("term", "data")}
            numbers = {name: batch.column(name) for name in ("last", "most", "place")}
            flat = {name: (c.offsets.to_numpy(), c.values.to_numpy()) for name, c in numbers.items()}
            shards, dfs = batch.column("shard").to_pylist(), batch.column("df").to_pylist()
            for i, term in enumerate(columns["term"].to_pylist()):
                if term is None:
                    self.docs[shards[i]] = tuple(batch.column(c)[i].values.to_numpy() for c in ("doc_ids", "sizes"))
                    continue
                parts = [values[offsets[i] : offsets[i + 1]].astype(np.int64) for offsets, values in flat.values()]
                self.lists[shards[i]][term] = _List(*parts, columns["data"][i].as_buffer(), dfs[i])

    def search(self, weights: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and doc_ids of the k best documents."""
        best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for shard, (doc_ids, sizes) in sorted(self.docs.items()):
            own = self.lists.get(shard, {})
            lists = sorted(((w * own[t].bound, w, own[t]) for t, w in weights.items() if t in own), key=lambda x: x[0])
            best = self._shard(lists, doc_ids, sizes, best)
        return best

    def _gains(self, postings: tuple[np.ndarray, np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return postings[0], impact(postings[1], sizes[postings[0]], *self.totals)

    def _shard(self, lists: list, doc_ids: np.ndarray, sizes: np.ndarray, best: tuple) -> tuple[np.ndarray, np.ndarray]:
        below = np.concatenate([[0], np.cumsum([bound for bound, _, _ in lists])])  # of all lists before
        self.blocks += sum(len(own.last) for _, _, own in lists)
        for a in range(0, len(doc_ids), WINDOW):
            b = min(a + WINDOW, len(doc_ids))
            # A score has to be above zero; one equal to the k-th may still win by its doc_id.
            least = max(1, int(best[0][-1]) if len(best[0]) == self.k else 0)
            essential = int(np.searchsorted(below[1:], least))  # lists before this one cannot make a score alone
            sums, seen = np.zeros(b - a, dtype=np.int64), np.zeros(b - a, dtype=bool)
            for _, w, own in lists[essential:]:
                first, after = np.searchsorted(own.last, [a, b])
                blocks = np.arange(first, min(after + 1, len(own.last)))
                if not len(blocks):
                    continue
                self.opened += len(blocks)
                doc, tf = own.read(blocks)
                inside = (doc >= a) & (doc < b)
                doc, gain = self._gains((doc[inside], tf[inside]), sizes)
                sums[doc - a] += w * gain
                seen[doc - a] = True
            alive = np.flatnonzero(seen)
            total = sums[alive]
            for number in range(essential - 1, -1, -1):
                if not len(alive):
                    break
                _, w, own = lists[number]
                good = total + below[number + 1] >= least
                alive, total = alive[good], total[good]
                block = np.searchsorted(own.last, alive + a)
                inside = block < len(own.last)
                top = np.where(inside, w * own.most[np.minimum(block, len(own.last) - 1)], 0)
                good = total + top + below[number] >= least
                alive, total, block, inside = alive[good], total[good], block[good], inside[good]
                wanted = np.unique(block[inside])
                if not len(wanted):
                    continue
                self.opened += len(wanted)
                doc, tf = own.read(wanted)
                at = np.minimum(np.searchsorted(doc, alive + a), len(doc) - 1)
                hit = doc[at] == alive + a
                _, gain = self._gains((doc[at[hit]], tf[at[hit]]), sizes)
                total[hit] += w * gain
            good = total >= least
            scores, found = np.concatenate([best[0], total[good]]), np.concatenate([best[1], doc_ids[alive[good] + a]])
            order = np.lexsort((found, -scores))[: self.k]
            best = scores[order], found[order]
        return best


def _searched(n_documents: int, occurrences: int, k: int):
    def search(rows: pa.Table, queries: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(n_documents, occurrences, k)
        searcher.add(rows)
        for batch in queries:
            for item, words in zip(batch.column("item_id").to_pylist(), batch.column("words").to_pylist()):
                scores, found = searcher.search({w["term"]: w["weight"] for w in words})
                if len(found):
                    yield pa.record_batch({"item_id": np.full(len(found), item), "doc_id": found, "score": scores})

    return search


def query_terms(items: DataFrame) -> DataFrame:
    """item_id and each of its terms once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms(text or ""))) for text in batch.column("text").to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(own)), [len(t) for t in own]), pa.int64())
            yield pa.record_batch({"item_id": batch.column("item_id").take(owner), "term": pa.array([t for ts in own for t in ts], pa.binary())})

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.filter("item_id IS NOT NULL").mapInArrow(run, "item_id bigint, term binary").distinct()


def ranked(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item."""
    n_documents, occurrences = counted(documents)
    wanted = settled(query_terms(items))
    known = wanted.select("term").distinct()
    index = settled(indexed(documents, n_documents, occurrences, known.select(F.xxhash64("term"))))
    lists = index.join(known, "term", "left_semi")
    share = (2.0 * n_documents + 2) / (2 * F.sum("df") + 1)
    weights = lists.groupBy("term").agg(F.floor(1000 * F.log(share)).alias("weight"))
    words = wanted.join(weights.filter("weight > 0"), "term").groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("words"))
    shards = index.filter("term IS NULL")
    # Shards are numbered by partition and place in it; dealt in that order, their groups are of one size.
    partition, place = F.expr("shard >> 32"), F.expr("shard & 4294967295")
    n_shards, most = shards.agg(F.count(F.lit(1)), F.max(place)).first()
    n_groups = max(1, n_shards)
    group = F.pmod(partition * ((most or 0) + 1) + place, F.lit(n_groups)).cast("int").alias("block")
    rows = lists.unionByName(shards).select("*", group)
    found = met(rows, settled(words), n_groups, _searched(n_documents, occurrences, k), "item_id bigint, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(documents: DataFrame, items: DataFrame) -> DataFrame:
    return ranked(documents.select("doc_id", "text"), items.select("item_id", "text"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT row, doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS occurrences FROM sized),
postings AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM sized) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, totals GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // occurrences))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sized USING (row), totals GROUP BY item_id, row),
places AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM places WHERE rank <= 50
"""
