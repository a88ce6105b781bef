"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a tree of elements; texts are slots. Neighbouring elements of the same kind, or of the same short
sequence of kinds, are folded into a repeated group, so a page becomes a small pattern whatever its length. The
patterns of a host are aligned one after another: elements that both have are merged, what only one has becomes
optional, and repetition is kept. Every ``LEVELS`` levels a tree of its own begins, known by its path, so that pages of
any depth are aligned alike.

Texts are aligned too. A block of text (what stands between two block elements) that the differing pages of a host
agree on at one place of the wrapper is a constant of it, template and not content: it stands on at least
``FEW_PAGES`` pages and on ``SHARE`` of those that have the place. What differs from page to page is a slot. Pages
with equal text count once, so copies of a page do not make its text a constant. A host with fewer pages has none.

A page's text is what fills its slots, without constants, in its main region: the main element, else articles,
else a content container, else the body; the first that the page itself has, so the templates of a host need not
agree. Whatever the wrapper has below a menu, footer, sidebar, notice, advert, form, script or comment is left out.

Equal patterns of a host are counted before the shuffle; the rest is aligned in salted parts whose number follows
that of the patterns, part results again likewise, reading rows one by one, so a task holds wrappers and no pages.
Blocks are counted by hashes (64 bits each of place and text). The result does not depend on the partitioning, as
rows are aligned in a fixed order.

Whatever has no host (NULL or odd url) forms one host. A NULL or empty page gives an empty text; broken markup
(open tags, cut pages) is read as far as it goes; very long and very deep pages are read whole. Repeated rows give
equal rows; an empty table an empty result; columns of clashing names are kept, but for one named main_text.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.support import packed, settled, unpacked

EACH = 2_000  # patterns that one task aligns
LEVELS = 60  # levels of one tree of a pattern
FEW_PAGES = 4
SHARE = 0.6
MOST_KINDS = 60  # longer sequences of different neighbours become one group of their kinds
FEW_BYTES = 4_000_000  # wrappers of all hosts up to this size are sent to the tasks; beyond it the join shuffles
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# What a starting element ends, if open.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
} | {tag: ("p",) for tag in BLOCKS - {"li", "dt", "dd", "tr", "td", "th", "caption", "tbody", "thead", "tfoot", "legend", "summary"}}
NOT_TEXT = frozenset("head title script style noscript template iframe object svg math canvas textarea nav footer aside form button select option datalist dialog menu".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe signup sidebar rail widget menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments reply replies "
    "discussion disqus share sharing social related recommended toolbar pagination pager login search form contentinfo complementary alert dialog hidden".split()
)
# What may follow a telling word in a class name without changing what it tells.
LAYOUT_WORDS = frozenset(
    "area bar block bottom box button buttons container desktop fixed group inner item items left link links list mobile outer panel posts "
    "primary right row secondary section slot sticky stories this top unit wrap wrapper".split()
)
NOT_ARTICLE_WORDS = frozenset("comment comments reply replies related ad ads sponsored".split())
PAGE_HEADER = frozenset(("header", "hgroup"))
CONTENT_WORDS = frozenset("content article post entry story".split())
NOISE, MAIN, ARTICLE, CONTENT, HEADER = 1, 2, 4, 8, 16
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|[^<]+|<""",
    re.S,
)
_MARKED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"

Node = list  # [kind, repeated, optional, children]; kind "#" is a text slot, "~" a group of neighbours


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _HOST, 1))


def _kind(tag: str, attributes: str) -> str:
    """An element's kind: its tag and the names in its class, id and role, without numbers."""
    if not attributes or attributes.isspace():
        return tag
    names = set()
    for name, *values in _MARKED.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() in ("hidden", "aria-hidden"):
            names.update(("hidden",) if value.lower() != "false" else ())
        else:
            names.update("-".join(w) for w in (re.findall(r"[a-z]+", n) for n in value.lower().split()) if w)
    return f"{tag}.{'.'.join(sorted(names))}" if names else tag


def _tells(name: str) -> str:
    """The word that says what a class name means: the last that is not about layout. 'site-footer-inner' is a footer,
    'hidden-gem' a gem."""
    words = name.split("-")
    return next((w for w in reversed(words) if w not in LAYOUT_WORDS), words[0])


@lru_cache(100_000)
def _marks(kind: str) -> int:
    """What an element of this kind means for the texts in it."""
    tag, *names = kind.split(".")
    words = {w for n in names for w in n.split("-")}
    told = {_tells(n) for n in names}
    if tag in NOT_TEXT or not told.isdisjoint(NOT_ARTICLE_WORDS if tag in ("article", "main") else NOT_TEXT_WORDS) and tag not in ("html", "body"):
        return NOISE
    marks = HEADER if tag in PAGE_HEADER or "header" in told else 0
    if tag in BLOCKS:
        marks |= MAIN if tag == "main" or "main" in words else 0
        marks |= ARTICLE if tag == "article" else 0
        marks |= 0 if CONTENT_WORDS.isdisjoint(words) else CONTENT
    return marks


Place = tuple[int, int]  # hash of the kinds from the root on, and what they mean together
ROOT: Place = (0, 0)


def _inside(place: Place, kind: str) -> Place:
    """The place of a child. Nothing inside noise starts a region."""
    marks = place[1] | (0 if place[1] & NOISE else _marks(kind))
    return xxhash.xxh64_intdigest(kind.encode("utf-8", "replace"), place[0]), marks


def events(page: str) -> Iterator[tuple[str, str]]:
    """("open" or "close", kind), ("text", text) and ("gap", "") in page order, with every element closed."""
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()

    def closed() -> tuple[str, str]:
        tag, kind = stack.pop()
        opened[tag] -= 1
        return "close", kind

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.match(page, at)
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            if page[found.start()] != "<" or found.end() == found.start() + 1:
                yield "text", found[0]
            continue
        tag = tag.lower()
        if not page[at - 1] == ">":
            break  # a tag cut off by the end of the page
        if found[1] or found[4]:
            left = opened[tag]
            while left and opened[tag] == left:
                yield closed()
            continue
        attributes = found[3] or found[6] or ""
        if tag in VOID:
            yield "gap", tag
            continue
        for ended in CLOSES.get(tag, ()):
            # An open element of that tag ends, unless a block lies between.
            for i in range(len(stack) - 1, -1, -1) if opened[ended] else ():
                if stack[i][0] == ended:
                    while len(stack) > i:
                        yield closed()
                    break
                if stack[i][0] in BLOCKS:
                    break
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if attributes.rstrip().endswith("/"):
            yield "gap", tag
            continue
        kind = _kind(tag, attributes)
        stack.append((tag, kind))
        opened[tag] += 1
        yield "open", kind
    while stack:
        yield closed()


def _key(node: Node) -> str:
    return node[0] if node[0] != "~" else "~" + ",".join(_key(c) for c in node[3])


def merged(a: Node, b: Node) -> Node:
    """One pattern for two of the same kind."""
    return [a[0], a[1] or b[1], a[2] or b[2], aligned(a[3], b[3])]


def _optional(node: Node) -> Node:
    return [node[0], node[1], True, node[3]]


def aligned(a: list[Node], b: list[Node]) -> list[Node]:
    """The longest common sequence merged, everything else optional, repetition folded."""
    if not a and not b:
        return []
    ka, kb = [_key(n) for n in a], [_key(n) for n in b]
    if ka == kb:
        return folded([merged(x, y) for x, y in zip(a, b)])
    best = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
    for i in range(len(ka) - 1, -1, -1):
        for j in range(len(kb) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(ka) and j < len(kb):
        if ka[i] == kb[j]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return folded(out + [_optional(n) for n in a[i:]] + [_optional(n) for n in b[j:]])


def folded(children: list[Node]) -> list[Node]:
    """Neighbours of one kind, or of one sequence of two or three kinds, become a repeated group."""
    out: list[Node] = []
    for node in children:
        if out and _key(out[-1]) == _key(node):
            last = merged(out[-1], node)
            out[-1] = [last[0], last[0] != "#", out[-1][2] and node[2], last[3]]
        else:
            out.append(node)
    for width in (2, 3):
        i = 0
        while i + 2 * width <= len(out):
            keys = [_key(n) for n in out[i : i + 2 * width]]
            if keys[:width] == keys[width:]:
                pairs = [merged(x, y) for x, y in zip(out[i : i + width], out[i + width : i + 2 * width])]
                out[i : i + 2 * width] = [["~", True, False, pairs]]
            elif out[i][0] == "~" and len(out[i][3]) == width and [_key(n) for n in out[i][3]] == [_key(n) for n in out[i + 1 : i + 1 + width]]:
                out[i] = ["~", True, out[i][2], [merged(x, y) for x, y in zip(out[i][3], out[i + 1 : i + 1 + width])]]
                del out[i + 1 : i + 1 + width]
            else:
                i += 1
    if len(out) > MOST_KINDS:
        kinds: dict[str, Node] = {}
        for node in (n for x in out for n in (x[3] if x[0] == "~" else [x])):
            kinds[_key(node)] = merged(kinds[_key(node)], node) if _key(node) in kinds else node
        out = [["~", True, False, [_optional(kinds[k]) for k in sorted(kinds)]]]
    return out


Forest = dict[str, Node]  # trees by the hash and the marks of their place


def pattern(page: str) -> Forest:
    """The folded trees of one page."""
    trees: Forest = {}
    stack: list[Node] = [["", False, False, []]]
    places = [ROOT]
    for what, value in events(page):
        if what == "open":
            stack.append([value, False, False, []])
            places.append(_inside(places[-1], value))
        elif what == "close":
            done, (path, marks) = stack.pop(), places.pop()
            done[3] = folded(done[3])
            if len(stack) % LEVELS == 0:
                key = f"{path}:{marks}"
                trees[key] = merged(trees[key], done) if key in trees else done
                done = [done[0], False, False, []]
            _append(stack[-1][3], done)
        elif what == "text" and not value.isspace():
            _append(stack[-1][3], ["#", False, False, []])
    stack[0][3] = folded(stack[0][3])
    trees[f"{ROOT[0]}:{ROOT[1]}"] = stack[0]
    return trees


def joined(a: Forest, b: Forest) -> Forest:
    """One wrapper for two."""
    return {k: merged(a[k], b[k]) if k in a and k in b else a.get(k) or b[k] for k in sorted({*a, *b})}


def _append(siblings: list[Node], node: Node) -> None:
    """Adds a sibling; one of the same kind as the last is folded at once, so long pages stay small."""
    if siblings and node[0] != "~" and siblings[-1][0] == node[0]:
        last = siblings[-1]
        siblings[-1] = [node[0], node[0] != "#", False, aligned(last[3], node[3])]
    else:
        siblings.append(node)


def slots(wrapper: Forest) -> dict[int, int]:
    """The places of the wrapper's text slots, and what they mean."""
    found: dict[int, int] = {}

    def walk(children: list[Node], place: Place) -> None:
        for node in children:
            if node[0] == "#":
                found[place[0]] = place[1]
            else:
                walk(node[3], place if node[0] == "~" else _inside(place, node[0]))

    for key, tree in wrapper.items():
        path, _, marks = key.partition(":")
        walk(tree[3], (int(path), int(marks)))
    return found


def blocks(page: str) -> Iterator[tuple[int, list[tuple[int, str]]]]:
    """The blocks of a page: the place of the block element, and its texts with the place of each."""
    places, around = [ROOT], [ROOT[0]]
    run: list[tuple[int, str]] = []
    for what, value in events(page):
        block = what in ("open", "close") and value.partition(".")[0] in BLOCKS
        if run and (block or (what, value) == ("gap", "hr")):
            yield around[-1], run
            run = []
        if what == "open":
            places.append(_inside(places[-1], value))
            around.append(places[-1][0] if block else around[-1])
        elif what == "close":
            places.pop()
            around.pop()
        elif what == "text":
            run.append((places[-1][0], value))
        elif value in ("br", "img"):
            run.append((places[-1][0], " "))
    if run:
        yield around[-1], run


def _read(page: str, known: dict[int, int]) -> tuple[list[tuple[int, int, str]], int]:
    """(place, marks, text) of the blocks outside noise, and the regions that the page has."""
    out, seen = [], 0
    for place, run in blocks(page):
        marks = 0
        kept = []
        for at, text in run:
            # A blank has no slot of its own unless other text stands there.
            own = known.get(at, 0)
            if not text.isspace():
                seen |= own
            if not own & NOISE:
                kept.append(text)
                marks |= own
        text = " ".join(html.unescape("".join(kept)).split())
        if text:
            out.append((place, marks, text))
    return out, seen


def _constant(place: int, text: str) -> int:
    """A block's key in the list of constants, as a signed 64-bit number."""
    key = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), place)
    return key - 2**64 if key >= 2**63 else key


def main_text(page: str | None, known: dict[int, int], constants: frozenset[int]) -> str:
    """The page's blocks that its host's wrapper has in slots of the main region; the best region the page has."""
    found, seen = _read(page or "", known)
    region = next((r for r in (MAIN, ARTICLE, CONTENT) if seen & r), 0)
    return "\n\n".join(
        text for place, marks, text in found if (marks & region if region else not marks & HEADER) and _constant(place, text) not in constants
    )


FOUND = "host string, pattern string, place bigint, block bigint, page bigint"


def _met(batches):
    """Per page: its pattern, the places of its blocks and the blocks, each with a hash of the page's text."""
    for batch in batches:
        rows: dict[tuple, None] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            trees = pattern(page or "")
            rows[host, json.dumps(trees, separators=(",", ":"), sort_keys=True), None, None, None] = None
            found, _ = _read(page or "", slots(trees))
            whole = xxhash.xxh64()
            for _, _, text in found:
                whole.update(text.encode("utf-8", "replace") + b"\n")
            own = whole.intdigest() - 2**63
            for place, _, text in found:
                rows[host, None, place - 2**63, None, own] = None
                rows[host, None, place - 2**63, _constant(place, text), own] = None
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*rows)) or [()] * 5
        names = ("host", "pattern", "place", "block", "page")
        yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def _aligned_rows(batches):
    """One pattern per host and part from sorted rows; a task holds one wrapper at a time."""
    group, wrapper = None, None

    def done():
        return pa.record_batch({"host": [group[0]], "pattern": [json.dumps(wrapper, separators=(",", ":"), sort_keys=True)]})

    for batch in batches:
        for *own, text in zip(batch.column("host").to_pylist(), batch.column("part").to_pylist(), batch.column("pattern").to_pylist()):
            trees = json.loads(text)
            if own == group:
                wrapper = joined(wrapper, trees)
            else:
                if group is not None:
                    yield done()
                group, wrapper = own, trees
    if group is not None:
        yield done()


def wrappers(pages: DataFrame) -> DataFrame:
    """host, ``pattern`` (the wrapper) and ``constants`` (its constant blocks) of every host."""
    met = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(_met, FOUND)
    # Copies of a page, and pages that differ in noise only, count once.
    met = met.distinct().groupBy("host", "pattern", "place", "block").agg(F.count(F.lit(1)).alias("n"))
    met = settled(met.filter(F.col("block").isNull() | (F.col("n") >= FEW_PAGES)))

    having = met.filter("place IS NOT NULL AND block IS NULL").select("host", "place", F.col("n").alias("having"))
    same = met.filter("block IS NOT NULL").select("host", "place", "block", "n").join(having, ["host", "place"])
    same = same.filter(F.col("n") >= SHARE * F.col("having")).groupBy("host").agg(F.sort_array(F.collect_set("block")).alias("constants"))

    found = met.filter("pattern IS NOT NULL").select("host", "pattern")
    while True:
        per = found.groupBy(F.col("host").alias("_host")).agg(F.ceil(F.count(F.lit(1)) / EACH).alias("parts"))
        part = F.pmod(F.xxhash64("pattern"), F.col("parts")).alias("part")
        dealt = found.join(per, F.col("host") == F.col("_host")).select("host", part, "pattern")
        dealt = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "pattern")
        found = settled(dealt.mapInArrow(_aligned_rows, "host string, pattern string"))
        if found.groupBy("host").count().filter("count > 1").isEmpty():
            break
    return found.join(same, "host", "left")


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` with ``main_text``."""
    known = settled(wrappers(pages)).withColumnRenamed("host", "_host")
    size = F.sum(F.length("pattern") + F.length("_host") + 8 * F.coalesce(F.size("constants"), F.lit(0)))
    known = F.broadcast(known) if (known.agg(size).first()[0] or 0) <= FEW_BYTES else known
    own = [c for c in pages.columns if c.lower() != "main_text"]
    rows = packed(pages, F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("_at"))
    rows = rows.join(known, F.col("_at") == F.col("_host"), "left")

    @F.arrow_udf("string")
    def text(page: pa.Array, at: pa.Array, pattern: pa.Array, constants: pa.Array) -> pa.Array:
        read: dict[str, tuple[dict[int, int], frozenset[int]]] = {}  # wrappers of the hosts of this batch
        out = []
        for i, (own_page, host) in enumerate(zip(page.to_pylist(), at.to_pylist())):
            if host not in read:
                read[host] = slots(json.loads(pattern[i].as_py())), frozenset(constants[i].as_py() or ())
            out.append(main_text(own_page, *read[host]))
        return pa.array(out, pa.string())

    return rows.select(*unpacked(own), text("html", "_at", "pattern", "constants").alias("main_text"))


def op4_wrapper_extraction(pages: DataFrame) -> DataFrame:
    rows = extracted(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))
