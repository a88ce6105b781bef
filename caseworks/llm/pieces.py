"""SentencePiece encoding and decoding with seeded merge-dropout.

The vocabulary is that of a public BPE model, read from the path given and sent to the tasks (its size is that of
the model file). Spaces become the meta symbol, a text starts with one, and neighbouring symbols whose joint piece
is in the vocabulary are merged by an agenda: best score first, leftmost first among equals. With dropout, each
candidate that is taken from the agenda is skipped by a draw of its own at the rate, keyed by seed, document, place
of the chunk in the text and step of the agenda; a skipped candidate comes back only as part of another merge.
Characters without a piece become byte pieces, and so does a literal meta symbol: decoding gives the exact text.

No piece reaches over the start of a word, so a text is cut into chunks there and the agenda runs per chunk. Every
occurrence of a chunk has its own draws. What it is cut into follows from the chunk and the steps that its draws
skip, so results are kept per (chunk, skipped steps) in a table of bounded size per worker: an occurrence starts at
the result without a skip and moves on by each skip that its draws hold among the steps taken there. What is not in
the table is solved together, one agenda step of every chunk at a time; both only save time.

NULL gives NULL and an empty text no pieces. The draw depends on doc_id (NULL is one value) and place, so reruns
and repeated rows agree. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.llm.flat_text import buffers, lists, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
LITERAL_META = "\udc81"  # stands for a meta symbol of the text; no text holds a lone surrogate
RATE = 0.1
SEED = 1
REMEMBERED = 600_000  # results per worker; the table is emptied once it has more
SHORT = 48  # longest chunk that is solved together with others
KEPT = 22  # longest chunk in the table: its agenda has at most 3 * 21 steps, so its draws fit into 64 bits
BATCH_CHARS = 1 << 19
_NONE = np.int64(2**62)
_M64 = (1 << 64) - 1


@dataclass(frozen=True)
class Vocabulary:
    pieces: dict[str, int]  # normal pieces
    scores: tuple[float, ...]
    bytes_of: tuple[bytes, ...]  # what each id decodes to
    byte_ids: tuple[int, ...]


def vocabulary(path: str = MODEL) -> Vocabulary:
    """The pieces of a model file, read by the driver."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, bytes_of, byte_ids = {}, [], [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        scores.append(model.get_score(i))
        bytes_of.append(b"")
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            bytes_of[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[piece] = i
            bytes_of[i] = piece.replace(META, " ").encode()
    return Vocabulary(pieces, tuple(scores), tuple(bytes_of), tuple(byte_ids))


class Encoder:
    def __init__(self, vocabulary: Vocabulary, rate: float = RATE, seed: int = SEED):
        self.v = vocabulary
        self.limit = int(rate * 65536)
        self.seed = seed
        pieces = vocabulary.pieces
        longer = [p for p in pieces if len(p) > 1]
        if any(META in p.lstrip(META) for p in longer):
            self.chunks = re.compile(r"(?s).+")  # pieces cross words: a text is one chunk
        elif any("\n" in p for p in longer):
            self.chunks = re.compile(f"{META}+[^{META}]*|[^{META}]+")
        else:
            self.chunks = re.compile(f"{META}+[^{META}\n]*|\n+|[^{META}\n]+")
        # Merge order: 0 for the best score, equal scores are equal.
        self.order = np.unique(-np.array(vocabulary.scores), return_inverse=True)[1].astype(np.int64)
        self.single = np.full(0x110000, -1, dtype=np.int64)
        for piece, number in pieces.items():
            if len(piece) == 1:
                self.single[ord(piece)] = number
        # (left, right) -> joint piece: a table with several places per key, where a key stands at the first free place.
        joints = {pieces[p[:i]] << 32 | pieces[p[i:]]: pieces[p] for p in longer for i in range(1, len(p)) if p[:i] in pieces and p[i:] in pieces}
        self.places = np.uint64(64 - max(4, (8 * len(joints)).bit_length()))
        self.joint_keys = np.full((1 << 64 - int(self.places)) + len(joints) + 1, _NONE, dtype=np.int64)
        self.joint_pieces = np.full(len(self.joint_keys), -1, dtype=np.int64)
        own = np.fromiter(joints, dtype=np.int64, count=len(joints))
        for key, joint, at in zip(own.tolist(), joints.values(), self._place(own).tolist()):
            while self.joint_keys[at] != _NONE:
                at += 1
            self.joint_keys[at], self.joint_pieces[at] = key, joint
        self._forget()

    def _forget(self) -> None:
        """Empties the table. Result i has ``count[i]`` ids from ``start[i]`` and took ``steps[i]`` steps of the agenda."""
        self.roots: dict[str, int] = {}  # chunk -> its result without a skip
        self.skips: dict[int, int] = {}  # result * 64 + next skipped step -> result
        self.start, self.count, self.steps = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.ids = np.zeros(0, dtype=np.int32)
        self.results = self.used = 0

    def _draws(self, keys: np.ndarray, block: int) -> np.ndarray:
        """64 draws of each key as bits, one for each step from 64 * ``block``; a bit is set at the rate."""
        if self.limit >> 16:
            return np.full(len(keys), np.uint64(_M64))
        out = np.zeros(len(keys), dtype=np.uint64)
        for i in range(16 if self.limit else 0):
            word = mix(keys ^ np.uint64((self.seed * 1024 + 16 * block + i + 1) * 0x9E3779B97F4A7C15 & _M64))
            out = word | out if self.limit >> i & 1 else word & out
        return out

    def pieces_of(self, chunk: str, key: int) -> list[int]:
        """The agenda for one chunk with the draws of ``key``."""
        pieces, order = self.v.pieces, self.order
        symbols: list[str] = list(chunk)
        n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            piece = pieces.get(symbols[i] + symbols[i + 1])
            if piece is not None:
                agenda.append((int(order[piece]), i, piece, 2))
        heapq.heapify(agenda)
        step, own = 0, np.array([key], dtype=np.uint64)
        while agenda:
            _, left, piece, width = heapq.heappop(agenda)
            right = following[left]
            # Out of date if either symbol has been merged since.
            if right >= n or not symbols[left] or len(symbols[left]) + len(symbols[right]) != width:
                continue
            if step % 64 == 0:
                draws = int(self._draws(own, step // 64)[0])
            step += 1
            if draws >> (step - 1) % 64 & 1:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after = following[left] = following[right]
            if after < n:
                before[after] = left
            for start, end in ((left, after), (before[left], left)):
                if start >= 0 and end < n:
                    joint = symbols[start] + symbols[end]
                    piece = pieces.get(joint)
                    if piece is not None:
                        heapq.heappush(agenda, (int(order[piece]), start, piece, len(joint)))
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                piece = pieces.get(symbol)
                if piece is not None:
                    ids.append(piece)
                else:
                    ids.extend(self._bytes(symbol))
        return ids

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.places).view(np.int64)

    def _joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = self._place(key)
        there = self.joint_keys[at]
        on = np.flatnonzero((there != key) & (there != _NONE))
        while len(on):
            at[on] += 1
            there[on] = self.joint_keys[at[on]]
            on = on[(there[on] != key[on]) & (there[on] != _NONE)]
        return np.where(there == key, self.joint_pieces[at], -1)

    def _solve_together(self, wanted: list[tuple[int, str]]) -> list[bytes]:
        """The ids of (key, chunk) pairs of short chunks."""
        ids, counts, _ = self._solve([chunk for _, chunk in wanted], keys=np.array([key for key, _ in wanted], dtype=np.uint64))
        ends = np.cumsum(counts).tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    def _solve(self, chunks: list[str], keys: np.ndarray | None = None, draws: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The agendas of short chunks, with the draws of their keys or those given: each round takes every chunk's best
        candidate. Gives all ids, their number per chunk, and the steps each chunk took."""
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbol, owner = self.single[points], np.repeat(np.arange(len(chunks)), lengths)
        symbol = np.where(symbol >= 0, symbol, -1 - points.astype(np.int64))  # below 0: characters without a piece
        place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        steps, step = np.zeros(len(chunks), dtype=np.int64), 0

        def candidates(at: np.ndarray) -> None:
            """Looks up what the symbols at these places make with the next one."""
            at = at[(at >= 0) & (at < len(symbol) - 1)]
            at = at[owner[at] == owner[at + 1]]
            found = self._joint(symbol[at], symbol[at + 1])
            piece[at] = found
            rank[at] = np.where(found >= 0, self.order[found] << 32 | place[at], _NONE)

        piece, rank = np.full(len(symbol), -1), np.full(len(symbol), _NONE)
        candidates(np.arange(len(symbol)))
        done_owner, done_symbol = [], []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.concatenate([starts, [len(symbol)]]))
            open_ = np.repeat(best != _NONE, sizes)
            if not open_.all():
                steps[owner[starts[best == _NONE]]] = step
                done_owner.append(owner[~open_])
                done_symbol.append(symbol[~open_])
                kept = np.flatnonzero(open_)
                best = np.repeat(best, sizes)[kept]
                symbol, owner, place, piece, rank = (x.take(kept) for x in (symbol, owner, place, piece, rank))
                if not len(symbol):
                    break
            else:
                best = np.repeat(best, sizes)
            at = np.flatnonzero(rank == best)
            if step % 64 == 0 and keys is not None:
                draws = self._draws(keys, step // 64)
            skip = (draws[owner[at]] >> np.uint64(step % 64) & np.uint64(1)).astype(bool)
            step += 1
            rank[at[skip]] = _NONE
            at = at[~skip]
            symbol[at] = piece[at]
            last = np.ones(len(symbol), dtype=bool)
            last[at + 1] = False
            at = (np.cumsum(last) - 1)[at]
            kept = np.flatnonzero(last)
            symbol, owner, place, piece, rank = (x.take(kept) for x in (symbol, owner, place, piece, rank))
            piece[at], rank[at] = -1, _NONE
            before = at[at > 0] - 1
            before = before[owner[before] == owner[before + 1]]
            piece[before], rank[before] = -1, _NONE
            candidates(np.concatenate([at, before]))
        owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
        at = np.argsort(owner, kind="stable")
        owner, symbol = owner[at], symbol[at]
        if (symbol < 0).any():
            kinds, which = np.unique(symbol, return_inverse=True)
            spelled = [[k] if k >= 0 else self._bytes(chr(-1 - k)) for k in kinds.tolist()]
            owner = np.repeat(owner, np.array([len(x) for x in spelled])[which])
            symbol = np.fromiter(chain.from_iterable(map(spelled.__getitem__, which.tolist())), dtype=np.int64, count=len(owner))
        return symbol.astype(np.int32), np.bincount(owner, minlength=len(chunks)), steps

    def _bytes(self, character: str) -> list[int]:
        return [self.v.byte_ids[b] for b in (META if character == LITERAL_META else character).encode()]

    def _keep(self, ids: np.ndarray, counts: np.ndarray, steps: np.ndarray | int = 0) -> np.ndarray:
        """Enters results; gives their numbers."""
        numbers = np.arange(self.results, self.results + len(counts))
        for name, size in (("start", numbers), ("count", numbers), ("steps", numbers), ("ids", ids)):
            old, used = getattr(self, name), self.used if name == "ids" else self.results
            if used + len(size) > len(old):
                new = np.zeros(max(1 << 12, used + len(size), len(old) * 3 // 2), dtype=old.dtype)
                new[:used] = old[:used]
                setattr(self, name, new)
        self.start[numbers] = self.used + np.cumsum(counts) - counts
        self.count[numbers] = counts
        self.steps[numbers] = steps
        self.ids[self.used : self.used + len(ids)] = ids
        self.results, self.used = self.results + len(counts), self.used + len(ids)
        return numbers

    def encode_all(self, texts: list[str | None], keys: list[int]) -> list[bytes]:
        """The ids of each text as 32-bit numbers; ``keys`` are the documents' own draws."""
        # Millions of small objects and no cycles: the search for cycles would take a sixth of the time.
        searching = gc.isenabled()
        gc.disable()
        try:
            return self._encode_all(texts, keys)
        finally:
            if searching:
                gc.enable()

    def _encode_all(self, texts: list[str | None], keys: list[int]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            chunks, drawn, ends, chars = [], [np.zeros(0, dtype=np.uint64)], [0], 0
            while at < len(texts) and (not chunks or chars < BATCH_CHARS):
                own = self._cut(texts[at] or "")
                chunks += own
                drawn.append(mix(np.arange(len(own), dtype=np.uint64) + np.uint64(keys[at])))
                ends.append(len(chunks))
                chars += len(texts[at] or "")
                at += 1
            if self.results > REMEMBERED:
                self._forget()
            results, used = self._resolved(chunks, np.concatenate(drawn))
            counts = self.count[results]
            before = np.concatenate([[0], np.cumsum(counts)])
            ids = self.ids[np.repeat(self.start[results] - before[:-1], counts) + np.arange(before[-1])]
            self.results, self.used = used
            cuts = before[ends].tolist()
            out.extend(ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:]))
        return out

    def _resolved(self, chunks: list[str], keys: np.ndarray) -> tuple[np.ndarray, tuple[int, int]]:
        """The result of each chunk with the draws of its key, and the size of the table without those that only serve once."""
        result = np.fromiter(map(self.roots.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        known, large = np.flatnonzero(result >= 0), np.flatnonzero(result < 0).tolist()
        # A chunk without a result is mostly a rare word: it is solved with its own draws, and enters once they skip no step.
        new = np.array([i for i in large if len(chunks[i]) <= KEPT], dtype=np.int64)
        if len(new):
            draws = self._draws(keys[new], 0)
            ids, counts, steps = self._solve([chunks[i] for i in new.tolist()], draws=draws)
            plain = draws & _steps(steps) == 0
            result[new[plain]] = self._keep(ids[np.repeat(plain, counts)], counts[plain], steps[plain])
            self.roots.update((chunks[i], r) for i, r in zip(new[plain].tolist(), result[new[plain]].tolist()))
            large = [i for i in large if len(chunks[i]) > KEPT]
        if self.limit:
            self._skip(chunks, keys, result, known)
        used = self.results, self.used
        if len(new):
            result[new[~plain]] = self._keep(ids[np.repeat(~plain, counts)], counts[~plain])
        short = [i for i in large if len(chunks[i]) <= SHORT]
        if short:
            result[short] = self._keep(*self._solve([chunks[i] for i in short], keys=keys[short]))
        for i in large:
            if len(chunks[i]) > SHORT:
                ids = np.array(self.pieces_of(chunks[i], int(keys[i])), dtype=np.int32)
                result[i] = self._keep(ids, np.array([len(ids)]))[0]
        return result, used

    def _skip(self, chunks: list[str], keys: np.ndarray, result: np.ndarray, at: np.ndarray) -> None:
        """Moves each chunk at these places from its result without a skip to the one of its own draws, skip by skip."""
        draws, past = self._draws(keys[at], 0), np.zeros(len(at), dtype=np.uint64)
        one = np.uint64(1)
        while True:
            # The draws of the steps that the result took, beyond the last skip.
            ahead = draws & _steps(self.steps[result[at]]) & ~past
            on = np.flatnonzero(ahead)
            if not len(on):
                return
            at, draws, ahead = at[on], draws[on], ahead[on]
            bit = ahead & (~ahead + one)
            past = bit | (bit - one)
            moves, first, which = np.unique(result[at] * 64 + np.bitwise_count(bit - one), return_index=True, return_inverse=True)
            to = np.fromiter(map(self.skips.get, moves.tolist(), repeat(-1)), dtype=np.int64, count=len(moves))
            new = np.flatnonzero(to < 0)
            if len(new):
                spot = first[new]
                to[new] = self._keep(*self._solve([chunks[i] for i in at[spot].tolist()], draws=draws[spot] & past[spot]))
                self.skips.update(zip(moves[new].tolist(), to[new].tolist()))
            result[at] = to[which]

    def _cut(self, text: str) -> list[str]:
        """The chunks of a text."""
        if not text:
            return []
        if META in text:
            text = text.replace(META, LITERAL_META)
        return self.chunks.findall(META + text.replace(" ", META))

    def encode(self, text: str, key: int) -> bytes:
        return self.encode_all([text], [key])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, without the space that every text starts with."""
        return b"".join(map(self.v.bytes_of.__getitem__, ids.tolist()))[1:].decode()


def _steps(n: np.ndarray) -> np.ndarray:
    """The bits of the first ``n`` steps, fewer than 64."""
    return (np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary, *options) -> Encoder:
    """One encoder per worker and vocabulary, so that its table serves several tasks."""
    key = (id(vocabulary), *options)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, *options)
    return _ENCODERS[key]


def document_key(doc_id: int | None, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{seed}:{doc_id}".encode())


def _rows_by_size(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``BATCH_CHARS`` bytes of text, so that memory does not follow the batch."""
    _, offsets = buffers(text)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_CHARS)))
        yield at, min(to, len(text))
        at = to


def _encoded(tool: Encoder, batch: pa.RecordBatch, seed: int) -> Iterator[tuple[pa.Array, pa.Array, list[bytes]]]:
    """doc_id, pieces and the bare ids of a few rows at a time."""
    for at, to in _rows_by_size(batch.column("text")):
        ids, text = batch.column("doc_id")[at:to], batch.column("text")[at:to]
        raw = tool.encode_all(text.to_pylist(), [document_key(i, seed) for i in ids.to_pylist()])
        counts = np.array([len(r) // 4 for r in raw], dtype=np.int64)
        pieces = lists(np.frombuffer(b"".join(raw), dtype=np.int32), counts, pa.int32())
        yield ids, pc.if_else(text.is_valid(), pieces, None), raw


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encoded(documents: DataFrame, vocabulary: Vocabulary, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id and ``pieces`` (array of ids; NULL for a NULL text) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        tool = _encoder(shared.value, rate, seed)
        for batch in batches:
            for ids, pieces, _ in _encoded(tool, batch, seed):
                yield pa.record_batch({"doc_id": ids, "pieces": pieces})

    return _texts(documents).mapInArrow(run, "doc_id bigint, pieces array<int>")


def decoded(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` (doc_id, pieces) with the ``text`` that the pieces spell."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        tool = _encoder(shared.value)
        for batch in batches:
            texts = [None if p.values is None else tool.decode(p.values.to_numpy(zero_copy_only=False)) for p in batch.column("pieces")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "pieces": batch.column("pieces"), "text": pa.array(texts, pa.string())})

    return rows.select("doc_id", "pieces").mapInArrow(run, "doc_id bigint, pieces array<int>, text string")


def pieces_and_text(documents: DataFrame, model: str = MODEL, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, ``pieces``, ``n_pieces`` and the digest of the text that the pieces decode to, for every row.

    The pieces are decoded where they are made, so that they leave the worker once.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(batches):
        tool = _encoder(shared.value, rate, seed)
        for batch in batches:
            for ids, pieces, raw in _encoded(tool, batch, seed):
                spelled = [tool.decode(np.frombuffer(r, dtype=np.int32)).encode() for r in raw]
                known = pieces.is_valid()
                yield pa.record_batch({
                    "doc_id": ids,
                    "pieces": pieces,
                    "n_pieces": pc.if_else(known, pa.array([len(r) // 4 for r in raw], pa.int64()), None),
                    "decoded_sha256": pc.if_else(known, pa.array([hashlib.sha256(t).hexdigest() for t in spelled], pa.string()), None),
                })

    return _texts(documents).mapInArrow(run, "doc_id bigint, pieces array<int>, n_pieces bigint, decoded_sha256 string")


def op9_merge_dropout(documents: DataFrame) -> DataFrame:
    return pieces_and_text(documents.select("doc_id", "text"))

