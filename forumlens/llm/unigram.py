"""Unigram pieces: Viterbi encoding over a double-array trie, and decoding.

Pieces and scores come from a SentencePiece model file.  A model of unigram type has log scores; the scores of
a merge model are the ranks of its merges, and piece r then gets the log score -log(r + ``ZIPF``), the
frequency law of ranked pieces, so that few frequent pieces win over many.

Text is cut before each run of blanks, as no piece holds a blank after another character; blanks become the marker
U+2581 and one marker is put in front (``decode`` takes it off).  Cuts are encoded one by one, each the best
path over all pieces that the trie finds, a character without piece costing ``UNKNOWN`` below the least score;
its bytes become byte pieces.  A marker that stands in the text itself is written as bytes, so decoding is exact.

The best paths of many distinct cuts are found side by side: at each position all cuts walk the trie together
in numpy, ``CELLS`` bytes of them at a time; a cut of more than ``LONG`` bytes, as in languages written without blanks, walks alone.
Batches are read in slices of about ``SLICE`` bytes.  Paths of cuts that two slices have in common are remembered per task;
what is remembered is bounded by bytes, as is what is held of one slice.

Defined results: null text: null ids and null text back; empty text: no ids and the empty text back; repeated rows: one
result each; an empty table: no rows; columns named like the results are replaced, others pass through.  Characters are not normalised.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
ZIPF = 10.0
UNKNOWN = 10.0
SLICE = 1 << 20
CELLS = 1 << 20
LONG = 512
# Bytes of cuts and paths remembered of the last slices, and for good.
RECENT = 4 << 20
REMEMBER = 16 << 20
_CUTS = re.compile(rb" +[^ ]*|[^ ]+")


class Pieces:
    """Double-array trie over the pieces' UTF-8 bytes: child c of node s is base[s] + c where check is s."""

    def __init__(self, pieces: list[tuple[bytes, int, float]], byte_ids: list[int]):
        self.byte_ids = np.array(byte_ids, dtype=np.int32)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[int, float]] = {}
        for piece, number, score in pieces:
            node = 0
            for b in piece:
                following = children[node].get(b)
                if following is None:
                    following = children[node][b] = len(children)
                    children.append({})
                node = following
            if node not in ends or score > ends[node][1]:
                ends[node] = (number, score)
        size = 4 * len(children) + 1024
        self.base = np.zeros(size, dtype=np.int32)
        self.check = np.full(size, -1, dtype=np.int32)
        self.piece = np.full(size, -1, dtype=np.int32)
        self.score = np.zeros(size, dtype=np.float64)
        free = np.ones(size, dtype=bool)
        free[0] = False
        place, queue, low = {0: 0}, [0], 257
        for node in queue:
            kids = sorted(children[node])
            if not kids:
                continue
            while not free[low]:
                low += 1
            at, span = low, 512
            while True:  # the first free places for all children, many tried at once
                tries = np.flatnonzero(free[at : at + span]) + at - kids[0]
                for k in kids[1:]:
                    tries = tries[free[tries + k]]
                if len(tries):
                    at = int(tries[0])
                    break
                at, span = at + span, 4 * span
            here = place[node]
            self.base[here] = at
            for k in kids:
                child = children[node][k]
                free[at + k] = False
                self.check[at + k] = here
                place[child] = at + k
                if child in ends:
                    self.piece[at + k], self.score[at + k] = ends[child]
                queue.append(child)
        used = int(np.flatnonzero(~free)[-1]) + 257
        for name in ("base", "check", "piece", "score"):
            setattr(self, name, getattr(self, name)[:used].copy())
        self.longest = max((len(p) for p, _, _ in pieces), default=1)
        self.unknown = min((s for _, _, s in pieces), default=0.0) - UNKNOWN

    def paths(self, cuts: list[bytes]) -> list[np.ndarray]:
        """Piece ids of the best path of each cut."""
        return [np.frombuffer(ids, dtype=np.int32) for ids in self.packed_paths(cuts)]

    def packed_paths(self, cuts: list[bytes]) -> list[bytes]:
        """The same as bytes of 32-bit integers."""
        out: list = [None] * len(cuts)
        order = sorted(range(len(cuts)), key=lambda i: len(cuts[i]))
        at = 0
        while at < len(order) and len(cuts[order[at]]) <= LONG:
            # Cuts of about one length walk together: padding stays small.
            reach = min(LONG, max(16, 2 * len(cuts[order[at]])))
            end = at + 1
            while end < len(order) and end - at < CELLS // (reach + 4) and len(cuts[order[end]]) <= reach:
                end += 1
            for i, ids in zip(order[at:end], self._paths([cuts[i] for i in order[at:end]])):
                out[i] = ids
            at = end
        for i in order[at:]:
            out[i] = self._path(cuts[i])
        return out

    def _path(self, cut: bytes) -> bytes:
        """The same for one long cut."""
        base, check, piece, scores = (memoryview(x) for x in (self.base, self.check, self.piece, self.score))
        n, limit = len(cut), len(check)
        best = array("d", [-math.inf]) * (n + 1)
        back, ids = array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for start in range(n):
            here = best[start]
            if here == -math.inf:
                continue
            lead = cut[start]
            end = min(n, start + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4))
            if here + self.unknown > best[end]:
                best[end], back[end], ids[end] = here + self.unknown, start, -1
            node = 0
            for end in range(start + 1, min(n, start + self.longest) + 1):
                following = base[node] + cut[end - 1]
                if base[node] <= 0 or following >= limit or check[following] != node:
                    break
                node = following
                if piece[node] >= 0 and here + scores[node] > best[end]:
                    best[end], back[end], ids[end] = here + scores[node], start, piece[node]
        return self._back(cut, back, ids)

    def _back(self, cut: bytes, back, ids) -> bytes:
        out: list[int] = []
        end = len(cut)
        while end:
            start, number = back[end], ids[end]
            if number >= 0:
                out.append(number)
            else:
                out.extend([int(self.byte_ids[b]) for b in reversed(cut[start:end])])
            end = start
        return array("i", out[::-1]).tobytes()

    def _paths(self, cuts: list[bytes]) -> list[bytes]:
        n, width = len(cuts), max(map(len, cuts))
        text = np.zeros((n, width + 4), dtype=np.int32)
        sizes = np.array([len(c) for c in cuts])
        for i, c in enumerate(cuts):
            text[i, : len(c)] = np.frombuffer(c, dtype=np.uint8)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 1), dtype=np.int32)
        piece = np.full((n, width + 1), -1, dtype=np.int32)
        lead = text[:, :width]
        step = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        for start in range(width):
            live = np.flatnonzero((sizes > start) & (best[:, start] > -np.inf))
            if not len(live):
                continue
            # One character without a piece is always a way on.
            to = np.minimum(start + step[live, start], sizes[live])
            here = best[live, start]
            better = here + self.unknown > best[live, to]
            rows = live[better]
            best[rows, to[better]] = here[better] + self.unknown
            back[rows, to[better]], piece[rows, to[better]] = start, -1
            node = np.zeros(len(live), dtype=np.int32)
            for end in range(start + 1, min(width, start + self.longest) + 1):
                fits = sizes[live] >= end
                following = self.base[node] + text[live, end - 1]
                fits &= (following < len(self.check)) & (self.base[node] > 0)
                fits &= self.check[np.where(fits, following, 0)] == node
                live, node, here = live[fits], following[fits], here[fits]
                if not len(live):
                    break
                score = here + self.score[node]
                better = (self.piece[node] >= 0) & (score > best[live, end])
                rows = live[better]
                best[rows, end], back[rows, end], piece[rows, end] = score[better], start, self.piece[node[better]]
        return [self._back(c, back[i].tolist(), piece[i].tolist()) for i, c in enumerate(cuts)]


def load(path: str = MODEL) -> tuple[Pieces, list[bytes]]:
    """The trie of a model file, and the bytes that each id decodes to (blanks for markers)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    normal, byte_ids, decoded = [], [0] * 256, []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            decoded.append(bytes([int(piece[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            decoded.append(b"")
        else:
            normal.append((i, piece.encode(), model.get_score(i)))
            decoded.append(piece.replace(MARK, " ").encode())
    fractional = any(s != int(s) for _, _, s in normal)
    first = min((i for i, _, _ in normal), default=0)
    scored = [(p, i, s if fractional else -math.log(i - first + ZIPF)) for i, p, s in normal]
    return Pieces(scored, byte_ids), decoded


class Encoder:
    """Encodes slices of text; remembers the paths of cuts that came up in two slices."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known: dict[bytes, bytes] = {}
        self.recent: dict[bytes, bytes] = {}
        self.known_bytes = self.recent_bytes = 0

    def _own(self, cut: bytes) -> bytes:
        """Path of a cut that holds markers of its own: these are written as bytes, the rest as ever."""
        mark = MARK.encode()
        raw = self.pieces.byte_ids[np.frombuffer(mark, dtype=np.uint8)].astype(np.int32).tobytes()
        parts: list[bytes] = []
        for k, part in enumerate(cut.split(mark)):
            if k:
                parts.append(raw)
            if part:
                parts.extend(self.pieces.packed_paths([part.replace(b" ", mark)]))
        return b"".join(parts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text end."""
        mark = MARK.encode()
        cut = [_CUTS.findall((" " + t).encode()) if t else [] for t in texts]
        paths: dict[bytes, bytes] = {}
        fresh: list[bytes] = []
        for c in {c for cs in cut for c in cs}:
            ids = self.known.get(c)
            if ids is None and (ids := self.recent.pop(c, None)) is not None:
                size = len(c) + len(ids)
                self.recent_bytes -= size
                if self.known_bytes + size > REMEMBER:
                    self.known, self.known_bytes = {}, 0
                self.known[c] = ids
                self.known_bytes += size
            if ids is None:
                fresh.append(c)
            else:
                paths[c] = ids
        plain = [c for c in fresh if mark not in c]
        new = dict(zip(plain, self.pieces.packed_paths([c.replace(b" ", mark) for c in plain])))
        new.update((c, self._own(c)) for c in fresh if mark in c)
        for c, ids in new.items():
            if self.recent_bytes > RECENT:
                self.recent, self.recent_bytes = {}, 0
            self.recent[c] = ids
            self.recent_bytes += len(c) + len(ids)
        paths.update(new)
        lists = [b"".join([paths[c] for c in cs]) for cs in cut]
        ends = np.cumsum([len(x) // 4 for x in lists])
        return np.frombuffer(b"".join(lists), dtype=np.int32), ends


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about ``SLICE`` characters."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def decode_ids(ids, decoded: list[bytes]) -> str:
    raw = b"".join([decoded[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode(errors="replace")


def encode(docs: DataFrame, path: str = MODEL, text: str = "text", to: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``to``: the piece ids of its text, and, if named, with ``decoded``: the text of these ids."""
    pieces, table = load(path)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, table if decoded else None))  # the size of the model file
    docs = docs.drop(to, *([decoded] if decoded else []))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table = shared.value
        encoder = Encoder(pieces)
        for batch in batches:
            for a, z in slices(batch.column(at).to_pylist()):
                part = batch.slice(a, z - a)
                texts = part.column(at).to_pylist()
                flat, ends = encoder.encode([t or "" for t in texts])
                none = pa.array([t is None for t in texts], pa.bool_())
                starts = np.concatenate([np.zeros(1, dtype=np.int64), ends])
                out = [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat), mask=none)]
                if decoded:
                    back = [None if t is None else decode_ids(flat[starts[k] : starts[k + 1]].tolist(), table) for k, t in enumerate(texts)]
                    out.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*batch.schema.names, to, *([decoded] if decoded else [])])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{to}` array<int>", *([f"`{decoded}` string"] if decoded else [])]))


def decode(coded: DataFrame, path: str = MODEL, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``coded`` with ``to``: the text of its piece ids."""
    _, decoded = load(path)
    shared = coded.sparkSession.sparkContext.broadcast(decoded)
    coded = coded.drop(to)
    at = coded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            lists = batch.column(at)
            starts, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            texts = [decode_ids(flat[starts[k] : starts[k + 1]].tolist(), table) if valid[k] else None for k in range(len(valid))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields]
    return coded.mapInArrow(run, ", ".join([*fields, f"`{to}` string"]))
