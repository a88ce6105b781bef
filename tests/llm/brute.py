"""Plain Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def near_duplicates(documents):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {}
    for doc_id, text in documents:
        own = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
        grams = [tuple(own[i : i + 5]) for i in range(len(own) - 4)] if len(own) >= 5 else [tuple(own)] if own else []
        sets[doc_id] = set(grams)
    holders = {}
    for doc_id, own in sets.items():
        for gram in own:
            holders.setdefault(gram, []).append(doc_id)
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for doc_id, own in sets.items():
        for other in {o for gram in own for o in holders[gram] if o > doc_id}:
            shared = len(own & sets[other])
            if 100 * shared >= 75 * (len(own) + len(sets[other]) - shared):
                a, b = find(doc_id), find(other)
                root[max(a, b)] = min(a, b)
    return {doc_id: (len(own), find(doc_id)) for doc_id, own in sets.items()}


def substring_dedup(documents, window=50):
    """{doc_id: (n_words, n_removed, digest of the kept words)}."""
    first = {}
    for doc_id, text in documents:
        own = words(text)
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, text in documents:
        own = words(text)
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(own) if i not in gone]
        out[doc_id] = (len(own), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def line_dedup(documents, run=3, many=50):
    """{doc_id: text without the lines of runs that start earlier}: runs of three lines, or of fewer with 50 words."""
    rows, first = {}, {}

    def runs(own):
        for s in range(len(own)):
            for e in range(s + 1, min(s + run, len(own)) + 1):
                found = tuple(x for _, x in own[s:e])
                if e - s == run or sum(len(words(x)) for x in found) >= many:
                    yield s, e, found

    for doc_id, text in sorted(documents):
        all_lines = (text or "").split("\n")
        rows[doc_id] = [(n, x.strip(" \t\x0b\x0c\r")) for n, x in enumerate(all_lines) if x.strip(" \t\x0b\x0c\r")]
        for s, _, found in runs(rows[doc_id]):
            first.setdefault(found, (doc_id, s))
    out = {}
    for doc_id, text in documents:
        gone = set()
        own = rows[doc_id]
        for s, e, found in runs(own):
            d, at = first[found]
            if (d, at) < (doc_id, s):
                gone.update(own[i][0] for i in range(s, e) if d != doc_id or i >= at + e - s)
        if not gone:
            out[doc_id] = text
            continue
        rest = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        out[doc_id] = rest if words(rest) else ""
    return out
