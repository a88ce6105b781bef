"""Near-duplicates by one-permutation hashing, banded buckets and star-shaped candidate links.

A document is the set of its five-word shingles (lower-cased A-Z). One hash per shingle fills 128 bins; empty bins
take the value of a bin drawn by optimal densification. Sets with few shingles would leave most bins to copies,
so their shingles are first repeated with salts (64 times up to 64 shingles, 8 times up to 512), which keeps the
similarity and makes the bins independent. The size classes overlap, so that two sets of similarity 0.75 always
share one. 32 bands of 4 bins give the bucket keys: a pair of similarity 0.75 misses all buckets with a
probability of about 5 in a million.

Equal sets are one class and take part once, by their smallest doc_id. The centre of a bucket is the member that
shares most buckets with others; in a group of copies that is their origin. A document is compared, on the full sets,
with the best centre of all its buckets, and in buckets whose members have several best centres and are not yet one
component also with that bucket's centre. Such stars link most of a group, and any two members of a bucket that are
still apart have a star in common.

Within a star, every member L is told by D(L), the shingles that only one of it and the centre has. A pair of n and m
shingles is alike (0.75) exactly if D(L) and D(M) have at least o = (|D(L)| + |D(M)| - (n + m) / 7) / 2 shingles in
common, which is at least one if either is not linked with the centre. In a common order a pair with o shingles in
common has k of them among the first |D| - o + k of each side, for every k up to o (a prefix filter; k is ``SHARED``).
First come shingles that are in D of one component only, which no two members apart have in common, then rare ones.
With the weight 7 |D| - n of a member, 14 o is the sum of both weights; so a shingle of D has room for partners up to a
weight that follows from its place, and a pair meets at it if the sum fits into the room of both. A member shows each
shingle once, and only those with room for the lightest member of another component. Rows whose room is under twice
their weight never fit one another; they meet the wider ones only. Near copies with changes of their own and excerpts
with endings of their own so seldom share enough to be compared. Pairs that do are compared on the full sets, once; no
bucket is capped and no link between members of a bucket is lost.

Results for odd rows: without text or words the set is empty and linked with nothing; fewer than five words make
one shingle of all words. Rows without a doc_id are linked with nothing and are kept. Rows that share a doc_id
are one document. Repeated rows give repeated result rows. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseworks.llm.components import components
from caseworks.llm.flat_text import Slice, buffers, constants, lists, mix, run_hashes, signed, slices
from caseworks.llm.ids import bit_map, possible
from caseworks.llm.support import in_parts, packed, settled

WORDS = 5
SIMILAR = 75  # percent
BINS, BAND = 128, 4
FEW_IDS = 500_000  # ids of 8 bytes that are sent to every task; with more the join shuffles
# (fewest shingles, most shingles, salted copies of each)
CLASSES = ((1, 64, 64), (49, 512, 8), (385, None, 1))
_U = np.uint64
SHARED = 4  # shingles of their prefixes that a pair has in common before it is compared
_SALTS = constants(21, 64)
_FACTORS = constants(22, BINS) | _U(1)
_EMPTY = _U(2**64 - 1)


def shingle_sets(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted per text, and the number of each text."""
    counts = part.counts
    n = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(n)
    inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
    start = np.repeat(part.first[:-1], n) + inner
    hashes = run_hashes(part.word_hashes(), start, start + np.repeat(np.minimum(counts, WORDS), n), 1)
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        hashes[a:b].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[(ends - n)[n > 0]] = True
    owner = np.repeat(np.arange(len(n)), n)[new]
    return hashes[new], np.bincount(owner, minlength=len(n))


def densified(bins: np.ndarray) -> np.ndarray:
    """Fill each empty bin from the bin that its own draw names first among the full ones."""
    empty = bins == _EMPTY
    full, attempt = bins.copy(), 0
    while empty.any():
        attempt += 1
        donors = (mix(np.arange(BINS, dtype=_U) * _U(1 << 20) + _U(attempt)) % _U(BINS)).astype(np.int64)
        given = bins[:, donors]
        full = np.where(empty, given, full)
        empty &= given == _EMPTY
    return full


def band_keys(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of all sets and their number per set."""
    owner = np.repeat(np.arange(len(counts)), counts)
    keys, owners = [], []
    for number, (fewest, most, copies) in enumerate(CLASSES):
        inside = (counts >= fewest) & (counts <= (most or np.inf))
        if not inside.any():
            continue
        local = np.cumsum(inside) - 1
        mine = inside[owner]
        values, base = hashes[mine], local[owner[mine]] * BINS
        bins = np.full(int(inside.sum()) * BINS, _EMPTY)
        for salt in _SALTS[:copies]:
            salted = mix(values ^ salt)
            np.minimum.at(bins, base + (salted >> _U(57)).astype(np.int64), salted)
        full = densified(bins.reshape(-1, BINS)) * _FACTORS
        bands = full.reshape(len(full), BINS // BAND, BAND).sum(axis=2, dtype=_U)
        keys.append(mix(bands ^ constants(23 + number, BINS // BAND)).ravel())
        owners.append(np.repeat(np.flatnonzero(inside), BINS // BAND))
    if not keys:
        return np.zeros(0, dtype=_U), np.zeros(len(counts), dtype=np.int64)
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], np.bincount(owners, minlength=len(counts))


def _described(batches):
    for batch in batches:
        for at, to, part in slices(batch.column("text"), lower=True):
            hashes, counts = shingle_sets(part)
            ends = np.concatenate([[0], np.cumsum(counts)])
            sums = []
            for salt in constants(26, 2):
                total = np.concatenate([[_U(0)], np.cumsum(mix(hashes ^ salt), dtype=_U)])
                sums.append(signed(total[ends[1:]] - total[ends[:-1]]))
            keys, n_keys = band_keys(hashes, counts)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id")[at:to],
                "n_shingles": pa.array(counts, pa.int64()),
                "set1": sums[0],
                "set2": sums[1],
                "bands": lists(signed(keys), n_keys, pa.int64()),
            })


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def described(documents: DataFrame) -> DataFrame:
    """Size, digest and bucket keys of every document's set."""
    return _texts(documents).mapInArrow(
        _described, "doc_id bigint, n_shingles bigint, set1 bigint, set2 bigint, bands array<bigint>"
    )


def _paired_sets(batch):
    """Row range, and per row the two sorted sets, of a batch of text pairs."""
    left, right = batch.column("text_a"), batch.column("text_b")
    for at, to, part in slices(left, lower=True):
        data, offsets = buffers(right[at:to])
        other = Slice(data[offsets[0] : offsets[-1]], offsets - offsets[0], lower=True)
        (ha, na), (hb, nb) = shingle_sets(part), shingle_sets(other)
        ea, eb = np.cumsum(na), np.cumsum(nb)
        yield at, to, [(ha[ea[i] - na[i] : ea[i]], hb[eb[i] - nb[i] : eb[i]]) for i in range(to - at)]


def _compared(batches):
    for batch in batches:
        for at, to, sets in _paired_sets(batch):
            shared = np.zeros(to - at, dtype=np.int64)
            for i, (a, b) in enumerate(sets):
                both = np.concatenate([a, b])
                both.sort()
                shared[i] = np.count_nonzero(both[1:] == both[:-1])
            yield pa.record_batch({
                "a": batch.column("a")[at:to],
                "b": batch.column("b")[at:to],
                "shared": shared,
                "na": pa.array([len(a) for a, _ in sets], pa.int64()),
                "nb": pa.array([len(b) for _, b in sets], pa.int64()),
            })


def _differences(batches):
    for batch in batches:
        for at, to, sets in _paired_sets(batch):
            own = [np.setxor1d(a, b, assume_unique=True) for a, b in sets]
            owner = pa.array(np.repeat(np.arange(at, to), [len(d) for d in own]))
            yield pa.record_batch({
                **{c: batch.column(c).take(owner) for c in ("a", "b", "root")},
                "shingle": signed(np.concatenate(own)),
            })


def _with_texts(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs (a, b), and what else their rows have, with both texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = possible(_texts(documents), "doc_id", documents.sparkSession.sparkContext.broadcast(bit_map(wanted, "id")))
    # The centres first: they are the hot side. The comparison itself is then dealt by the other member.
    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    with_a = in_parts(with_a, pairs.count(), each=1000)
    with_both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return with_both.select(*pairs.columns, "text_a", "text_b")


def compared(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs with the sizes of both sets, what they share, and whether that makes a link."""
    rows = _with_texts(pairs.select("a", "b"), documents).mapInArrow(_compared, "a bigint, b bigint, shared bigint, na bigint, nb bigint")
    return rows.withColumn("linked", 100 * F.col("shared") >= SIMILAR * (F.col("na") + F.col("nb") - F.col("shared")))


def _members(rows: DataFrame) -> DataFrame:
    """Rows (key, rep, size, weight) of the buckets with several members, from rows (key, rep); ``weight`` is the
    sum of a member's bucket sizes."""
    # Settled, so that the join meets it as a plain shuffle and can split a hot bucket.
    sizes = settled(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    live = settled(rows.join(sizes, "key"))
    weights = live.groupBy("rep").agg(F.sum("size").alias("weight"))
    return settled(live.join(weights, "rep").select("key", "rep", "size", "weight"))


def _rooted(rows: DataFrame, roots: DataFrame, node: str) -> DataFrame:
    """``rows`` with the ``root`` of a node; a node without links is its own."""
    own = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    rows = rows.join(own, F.col(node) == F.col("_node"), "left")
    return rows.withColumn("root", F.coalesce("_root", node)).drop("_node", "_root")


def _placed(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members with the centre of their bucket (key, rep, centre), and each member's own best centre: the one of
    all its buckets that shares most buckets with others."""
    centre = F.max(F.struct("weight", (-F.col("rep")).alias("low"))).alias("c")
    rows = members.select("key", "rep").join(settled(members.groupBy("key").agg(centre)), "key")
    best = rows.groupBy("rep").agg((-F.max("c")["low"]).alias("best"))
    return rows.select("key", "rep", (-F.col("c.low")).alias("centre")), settled(best)


def _split_buckets(placed: DataFrame, best: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of the centre and each other member, of the buckets whose members lie in several components and
    have several best centres."""
    rows = _rooted(placed.join(best, "rep"), roots, "rep")
    differ = [F.min("root") != F.max("root"), F.min("best") != F.max("best")]
    split = rows.groupBy("key").agg((differ[0] & differ[1]).alias("split")).filter("split").select("key")
    return rows.join(settled(split), "key").filter("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()


def _shown(members: DataFrame) -> DataFrame:
    """Rows (a, shingle, b, root, nb, weight, room) of what members show in their star, from rows (a, b, own, root, differ,
    nb); ``own`` are the shingles of D that members of several components have, rarest first. Partners may weigh up to
    ``room`` less the own weight."""
    weighed = members.withColumn("weight", 7 * F.col("differ") - F.col("nb"))
    lightest = settled(weighed.groupBy("a").agg(F.min(F.struct("weight", "root")).alias("first")))
    weighed = weighed.join(lightest, "a")
    second = weighed.filter("root != first.root").groupBy("a").agg(F.min("weight").alias("second"))
    weighed = weighed.join(settled(second), "a")
    partner = F.when(F.col("root") == F.col("first.root"), F.col("second")).otherwise(F.col("first.weight"))
    need = F.greatest(F.lit(1), F.ceil((F.col("weight") + partner) / 14))
    size = F.size("own")
    length = F.when(need <= size, size - need + F.least(need, F.lit(SHARED))).otherwise(0).cast("int")
    shown = weighed.select("a", "b", "root", "nb", "weight", size.alias("_size"), F.posexplode(F.slice("own", F.lit(1), length)).alias("_at", "shingle"))
    room = 14 * F.least(F.col("_size") - F.col("_at") + SHARED - 1, F.col("_size")).cast("bigint")
    return shown.select("a", "shingle", "b", "root", "nb", "weight", room.alias("room"))


def _possible_pairs(apart: DataFrame, documents: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one star, of different components, that may be alike."""
    rows = apart.select("a", "b", "root")
    shingles = settled(_with_texts(rows, documents).mapInArrow(_differences, "a bigint, b bigint, root bigint, shingle bigint"))
    known = shingles.groupBy("a", "shingle").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    own = shingles.join(settled(known.filter("r1 != r2").select("a", "shingle", "n")), ["a", "shingle"])
    own = own.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("n", "shingle")))["shingle"].alias("own"))
    sizes = apart.select("a", "b", "root", (F.col("na") + F.col("nb") - 2 * F.col("shared")).alias("differ"), "nb")
    shown = settled(_shown(settled(own.join(sizes, ["a", "b"]))))
    several = shown.groupBy("a", "shingle").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.min("weight").alias("lightest"))
    several = settled(several.filter("r1 != r2").select("a", "shingle", "lightest"))
    met = settled(shown.join(several, ["a", "shingle"]).filter("weight + lightest <= room").drop("lightest"))
    wide = met.filter("2 * weight <= room")
    other = met.select("a", "shingle", *[F.col(name).alias(f"_{name}") for name in ("b", "root", "nb", "weight", "room")])
    pairs = wide.join(other, ["a", "shingle"]).filter("root != _root AND (b < _b OR 2 * _weight > _room)")
    pairs = pairs.filter("weight + _weight <= least(room, _room) AND 4 * least(nb, _nb) >= 3 * greatest(nb, _nb)")
    need = F.greatest(F.lit(1), F.ceil((F.col("weight") + F.col("_weight")) / 14))
    pairs = pairs.groupBy(F.least("b", "_b").alias("a"), F.greatest("b", "_b").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(need).alias("need"))
    return pairs.filter(F.col("n") >= F.least(F.col("need"), F.lit(SHARED))).select("a", "b")


def linked(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """``node`` and ``root`` of the classes that are linked with another one."""
    members = _members(classes.select("rep", F.explode("bands").alias("key")))
    placed, best = _placed(members)
    stars = settled(compared(best.filter("best != rep").select(F.col("best").alias("a"), F.col("rep").alias("b")), documents))
    stars = in_parts(stars, stars.count())
    roots = settled(components(stars.filter("linked").select("a", "b")))
    further = settled(_split_buckets(placed, best, roots).join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    stars = stars.unionByName(settled(compared(in_parts(further, further.count()), documents)))
    links = stars.filter("linked").select("a", "b")
    roots = settled(components(links))
    roots = in_parts(roots, roots.count())
    apart = _rooted(stars, roots, "b")
    open_stars = apart.groupBy("a").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 != r2").select("a")
    apart = settled(apart.join(open_stars, "a"))
    n_apart = apart.count()
    if not n_apart:
        return roots
    pairs = settled(_possible_pairs(in_parts(apart, n_apart), documents))
    n_pairs = pairs.count()
    if not n_pairs:
        return roots
    found = settled(compared(in_parts(pairs, n_pairs), documents).filter("linked").select("a", "b"))
    # The links between what was found so far are its roots.
    links = in_parts(found, found.count()).unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = settled(components(links))
    return in_parts(roots, roots.count())


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, for every row of ``documents``."""
    sets = settled(described(documents))
    digest = ["set1", "set2", "n_shingles"]
    filled = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = settled(filled.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    roots = linked(classes, documents)
    classes = classes.select(*digest, "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select(*digest, F.coalesce("root", "rep").alias("root"))
    rows = sets.select("doc_id", *digest).join(classes, digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(documents: DataFrame) -> DataFrame:
    """``documents`` without those that have a similar one with a smaller doc_id; of rows that share a doc_id the
    one with the smallest text stays."""
    verdicts = settled(near_duplicates(documents))
    gone = settled(verdicts.filter("doc_id != component_id").select("doc_id").distinct())
    again = verdicts.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    again = settled(again)
    left_out = gone.unionAll(again)
    left_out = F.broadcast(left_out) if left_out.count() <= FEW_IDS else left_out
    rest = documents.join(left_out, "doc_id", "left_anti")
    if not again.isEmpty():
        place = F.row_number().over(Window.partitionBy("_own.doc_id").orderBy("_own.text")).alias("_place")
        first = packed(documents.join(again, "doc_id", "left_semi")).select("_own", place).filter("_place = 1")
        rest = rest.unionByName(first.select("_own.*"))
    return rest.select(*[F.col(f"`{c}`") for c in documents.columns])


def op3_minhash_near_dedup(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents.select("doc_id", "text"))
