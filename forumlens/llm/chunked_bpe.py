"""Byte-level BPE encoding that encodes content-defined chunks once, and decoding.

Texts are cut where a rolling hash of the last 32 bytes meets a fixed pattern, so equal passages of different documents
mostly fall into equal chunks, wherever they stand.  A first reading counts the chunks' hashes; hashes met more than once make a bit
filter sized by their number, up to ``FILTER_BITS``.  A document without such a chunk shares nothing and is encoded where it is read.  The
chunks of all others (a filter that errs only adds documents) meet by their digest; each distinct chunk is encoded once and its
ids go back to all places it was met at.  There the ids of a document's chunks are joined: what a chunk says near its ends may be wrong,
as words and blanks may run on, so from the last place known to be right the text is encoded anew over the join until its words
begin where the next chunk's do.  From that place on the chunk's ids are exact, as a word depends on nothing before its start.
If the two never agree the whole chunk is encoded anew.  Special tokens cut a text before everything else.

A chunk that one batch of rows holds ``HOT`` times or more is dealt with apart for that batch: its digest is salted, so a chunk
in a third of all documents spreads over many tasks (each encodes it once) instead of meeting in one.

The tokenizer file (vocabulary, merges, special tokens) is a parameter.  Which characters are letters, digits or blanks is asked of
the tokenizers library once, on the driver, as its Unicode tables are its own; encoding itself is done here.

Defined results: null or empty text: no ids, decoded to the empty text; repeated rows, repeated or null keys: one result for
each row; an empty table: no rows; texts of any length are chunked whole; only the key columns and the text are read, so further columns don't
matter, and internal columns are prefixed so that keys may have any name but the results' own (``ids``, ``decoded``).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.session import freeze

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# Chunks: at least LEAST bytes, 1 / 2 ** BITS of the places after that end one, at most MOST bytes (and the rest of a character).
LEAST, BITS, MOST = 128, 9, 8192
WINDOW = 32
HOT = 64
HEADS = 4
# A word whose end is this many characters from the end of the known text can't change any more: "'ll" looks furthest.
SETTLED = 3
# Words longer than this many bytes merge by a queue, and are not remembered; remembered words; chunks whose text was sent;
# hashes counted before they are passed on.
SHORT = 64
MEMO = 150_000
SENT = 100_000
COUNTED = 200_000
FILTER_BITS = 1 << 28

_GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)), dtype="<u4")


def ends_of_chunks(raw: bytes) -> list[int]:
    """Where the chunks of UTF-8 text end; the last end is that of the text."""
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    data = np.frombuffer(raw, dtype=np.uint8)
    h = _GEAR[data]
    step = 1
    while step < WINDOW:  # sums of shifted terms over 2, 4, ... 32 bytes
        h[step:] += h[:-step] << np.uint32(step)  # the right side is made before the sum
        step *= 2
    starts_character = (data & 0xC0) != 0x80
    marks = np.flatnonzero((h >> np.uint32(32 - BITS)) == 0) + 1
    marks = marks[marks < n]
    marks = marks[starts_character[marks]]
    out: list[int] = []
    at = 0
    while n - at > LEAST:
        k = int(np.searchsorted(marks, at + LEAST))
        end = int(marks[k]) if k < len(marks) else n
        if end - at > MOST:
            end = at + MOST
            while end < n and not starts_character[end]:
                end += 1
        out.append(end)
        at = end
    if at < n:
        out.append(n)
    return out


def _byte_letters() -> dict[str, int]:
    """The characters by which vocabulary files write bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


# The public pattern of words of this kind of vocabulary, by Unicode class.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _classes(pre_tokenizer) -> tuple[list[str], str, str]:
    """Letters, digits and blanks as the library sees them, as ranges of a character class, the characters that ``regex``
    has in another class, and the first few hundred of those it has in the same."""
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    ours = [set(regex.findall(c, everything)) for c in (r"\p{L}", r"\p{N}", r"\s")]
    named = {c for c in everything if unicodedata.category(c)[0] in "LNZ" or c.isspace()}
    likely = sorted(named.union(*ours))
    theirs: list[set[str]] = []
    for before in "a1":  # a character of the same kind is no start of its own after it
        text = "".join(f"{before}{c}\x00" for c in likely)
        starts = {span[0] for _, span in pre_tokenizer.pre_tokenize_str(text)}
        theirs.append({c for k, c in enumerate(likely) if 3 * k + 1 not in starts})
    text = "".join(f"!{c}\x00" for c in likely)
    starts = {span[0] for _, span in pre_tokenizer.pre_tokenize_str(text)}
    theirs.append({c for k, c in enumerate(likely) if 3 * k + 1 in starts} - theirs[0] - theirs[1])
    other = set().union(*(a ^ b for a, b in zip(ours, theirs)))
    usual = [c for c in range(min([ord(c) for c in other if c > "~"], default=0x300)) if chr(c) not in other]
    return [_ranges(sorted(map(ord, chars))) for chars in theirs], _ranges(sorted(map(ord, other))), _ranges(usual)


def _ranges(codes: list[int]) -> str:
    out, first = [], None
    for k, c in enumerate(codes):
        first = c if first is None else first
        if k + 1 == len(codes) or codes[k + 1] != c + 1:
            out.append(f"\\U{first:08x}-\\U{c:08x}")
            first = None
    return "".join(out)


class Tokenizer:
    """Vocabulary, merges and word pattern of one file; encodes with a bounded memory of words."""

    def __init__(self, path: str = TOKENIZER):
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        letters = _byte_letters()
        as_bytes = lambda piece: bytes(letters[c] for c in piece)
        vocabulary = stated["model"]["vocab"]
        special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        self.byte_ids = [0] * 256
        for c, b in letters.items():
            self.byte_ids[b] = vocabulary[c]
        # Pair of ids (left in the high half) to rank (high half) and new id.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(stated["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocabulary[left] << 32 | vocabulary[right], rank << 32 | vocabulary[left + right])
        self.pieces = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for piece, i in vocabulary.items():
            self.pieces[i] = as_bytes(piece)
        for content, i in special.items():
            self.pieces[i] = content.encode()
        self.kind, self.code = ("<u2", "H") if len(self.pieces) <= 1 << 16 else ("<u4", "I")
        self.special = {content: np.array([i], dtype=self.kind).tobytes() for content, i in special.items() if content}
        (letter, digit, blank), self.other, self.usual = _classes(Library.from_file(path).pre_tokenizer)
        self.pattern = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{blank}{letter}{digit}]+"
                        rf"|[{blank}]+(?![^{blank}])|[{blank}]+")
        self.ready()

    def ready(self) -> None:
        # The pattern by Unicode class is faster; texts with a character that the library classes otherwise take that by ranges.
        self.plain = regex.compile(WORDS).findall
        self.exact = re.compile(self.pattern).findall
        self.doubtful = re.compile(f"[{self.other}]").search if self.other else lambda text: None
        # Most texts have no character beyond the first doubtful one; that is seen at once.
        self.unusual = re.compile(f"[^{self.usual}]").search
        letters = bytes(self.byte_ids) if max(self.byte_ids) < 256 else None
        self.letters = (lambda raw: list(raw.translate(letters))) if letters else lambda raw: [self.byte_ids[b] for b in raw]
        self.cut_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        return self.exact(text) if self.unusual(text) and self.doubtful(text) else self.plain(text)

    def state(self) -> dict:
        """Plain values to make the same tokenizer of elsewhere."""
        return {k: v for k, v in self.__dict__.items() if k not in ("plain", "exact", "doubtful", "unusual", "letters", "cut_special", "memo", "older")}

    @classmethod
    def of(cls, state: dict) -> Tokenizer:
        """The tokenizer of a broadcast state; tasks that share a Python worker share it, and the words it remembers."""
        if "live" not in state:
            out = cls.__new__(cls)
            out.__dict__.update(state)
            out.ready()
            state["live"] = out
        return state["live"]

    def word(self, word: str) -> bytes:
        """Ids of one word, as bytes of ``kind``: adjacent pieces merge by rank, the leftmost first."""
        ids = self.memo.get(word)
        if ids is None:
            ids = self.older.get(word)
            raw = word.encode()
            if ids is None:
                merge = self._merged if len(raw) <= SHORT else self._merged_long
                ids = array(self.code, merge(self.letters(raw))).tobytes()
            if len(raw) <= SHORT:
                if len(self.memo) >= MEMO:  # words met since the last change stay
                    self.older, self.memo = self.memo, {}
                self.memo[word] = ids
        return ids

    def coded(self, words: list[str]) -> list[bytes]:
        known, word = self.memo.get, self.word
        return [known(w) or word(w) for w in words] if len(self.memo) + len(words) < MEMO else [word(w) for w in words]

    def _merged(self, ids: list[int]) -> list[int]:
        found = self.merges.get
        none = 1 << 62
        pairs = [found(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            k = pairs.index(least)
            ids[k] = least & 0xFFFFFFFF
            del ids[k + 1], pairs[k]
            if k < len(pairs):
                pairs[k] = found(ids[k] << 32 | ids[k + 1], none)
            if k:
                pairs[k - 1] = found(ids[k - 1] << 32 | ids[k], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        found, n = self.merges.get, len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(m >> 32, k) for k in range(n - 1) if (m := found(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, k = heapq.heappop(queue)
            right = after[k]
            if ids[k] < 0 or right < 0:
                continue
            m = found(ids[k] << 32 | ids[right])
            if m is None or m >> 32 != rank:
                continue
            ids[k], ids[right] = m & 0xFFFFFFFF, -1
            after[k] = after[right]
            if after[k] >= 0:
                before[after[k]] = k
                if (m := found(ids[k] << 32 | ids[after[k]])) is not None:
                    heapq.heappush(queue, (m >> 32, k))
            if before[k] >= 0 and (m := found(ids[before[k]] << 32 | ids[k])) is not None:
                heapq.heappush(queue, (m >> 32, before[k]))
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> bytes:
        return b"".join(self.coded(self.words(text)))

    def bytes_of(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, dtype=self.kind).tolist()])

    def chunk(self, text: str) -> tuple[bytes, list[int]]:
        """Ids of a chunk by itself; the token where its last settled word ends, and where its first words begin up to there."""
        words = self.words(text)
        coded = self.coded(words)
        size = np.dtype(self.kind).itemsize
        left, settled = 0, len(words)
        while settled and left < SETTLED:
            settled -= 1
            left += len(words[settled])
        begins, at = [], 0
        for k, ids in enumerate(coded[:settled]):
            if k < HEADS:
                begins.append(at)
            at += len(ids) // size
        if settled < HEADS:
            begins.append(at)
        return b"".join(coded), [at, *begins]


@functools.cache
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


class _Joiner:
    """Ids of one stretch of text from those of its chunks in order."""

    def __init__(self, tokenizer: Tokenizer):
        self.t = tokenizer
        self.size = np.dtype(tokenizer.kind).itemsize
        self.ids: list[bytes] = []
        self.open: str | None = None  # text from a true start of a word on, not encoded for good yet

    def add(self, ids: bytes, marks: list[int]) -> None:
        t, size = self.t, self.size
        tail = marks[0] * size
        if self.open is None:
            self.ids.append(ids[:tail])
            self.open = t.bytes_of(ids[tail:]).decode()
            return
        head = marks[-1] * size
        starts = {}
        place = 0
        for a, b in zip(marks[1:], [*marks[2:], marks[-1]]):
            starts[place] = a * size
            place += len(t.bytes_of(ids[a * size : b * size]).decode())
        text = self.open + t.bytes_of(ids[:head]).decode()
        known = len(text) - SETTLED
        base, place, fresh = len(self.open), 0, []
        for w in t.words(text):
            if place >= base and place - base in starts:  # the words agree from here on
                self.ids += fresh
                self.ids.append(ids[starts[place - base] : tail])
                self.open = t.bytes_of(ids[tail:]).decode()
                return
            if place + len(w) > known:
                break
            fresh.append(t.word(w))
            place += len(w)
        # No agreement in the known head: the chunk is encoded anew as a whole, but for its unsettled end.
        text = self.open + t.bytes_of(ids).decode()
        words = t.words(text)
        left, settled = 0, len(words)
        while settled and left < SETTLED:
            settled -= 1
            left += len(words[settled])
        self.ids += [t.word(w) for w in words[:settled]]
        self.open = "".join(words[settled:])

    def close(self) -> None:
        if self.open is not None:
            self.ids.append(self.t.encode(self.open))
            self.open = None


def _sections(tokenizer: Tokenizer, text: str) -> Iterator[tuple[int, str]]:
    """Stretches between special tokens (1) and special tokens themselves (0)."""
    at = 0
    for m in tokenizer.cut_special.finditer(text) if tokenizer.cut_special else ():
        if m.start() > at:
            yield 1, text[at : m.start()]
        yield 0, m.group()
        at = m.end()
    if at < len(text):
        yield 1, text[at:]


def _chunks_of(tokenizer: Tokenizer, text: str) -> Iterator[tuple[int, int, bytes]]:
    """Chunks in order: the number of its stretch, whether it is plain text, and its bytes."""
    for number, (plain, section) in enumerate(_sections(tokenizer, text)):
        raw = section.encode()
        start = 0
        for end in ends_of_chunks(raw) if plain else [len(raw)]:
            yield number, plain, raw[start:end]
            start = end


def _bits_of(hashes: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes % np.uint64(n_bits)).astype(np.int64), ((hashes >> np.uint64(32)) * np.uint64(31) % np.uint64(n_bits)).astype(np.int64)


def _shared(bits: np.ndarray, parts: list[bytes]) -> bool:
    """Whether any of the chunks may stand elsewhere too."""
    hashes = np.array([xxhash.xxh64_intdigest(p) for p in parts], dtype=np.uint64)
    one, other = _bits_of(hashes, 8 * len(bits))
    return bool(((bits[one >> 3] >> (one & 7).astype(np.uint8)) & (bits[other >> 3] >> (other & 7).astype(np.uint8)) & 1).any())


def shared_chunks(docs: DataFrame, text: str, tokenizer, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Filter of the chunks that stand in more than one place: 8 bits for each, ``most_bits`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer.of(tokenizer.value)
        counts: dict[int, int] = {}

        def out() -> pa.RecordBatch:
            hashes = np.fromiter(counts, np.uint64, len(counts)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(counts.values()), pa.int64())], names=["h", "n"])

        for batch in batches:
            for content in batch.column(0).to_pylist():
                for _, plain, part in _chunks_of(t, content or ""):
                    if plain:
                        h = xxhash.xxh64_intdigest(part)
                        counts[h] = counts.get(h, 0) + 1
                if len(counts) >= COUNTED:
                    yield out()
                    counts.clear()
        yield out()

    met = docs.select(text).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    met = freeze(met.filter(F.col("n") > 1).select("h"), "shared_chunks")
    n_bits = 1 << min(most_bits.bit_length() - 1, max(10, (8 * met.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_bits_of(batch.column(0).to_numpy().view(np.uint64), n_bits))
            cell, where = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(cell), dtype=np.int64)
            np.bitwise_or.at(bits, where, np.int64(1) << (at & 63))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits)], names=["cell", "bits"])

    got = met.mapInArrow(places, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()  # n_bits / 64 rows at most
    out = np.zeros(n_bits // 64, dtype="<i8")
    out[got.column("cell").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _alone(read: DataFrame, bits, tokenizer) -> DataFrame:
    """Ids of the rows that share no chunk, encoded where they are read."""
    n_keys = len(read.columns) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, filter_ = Tokenizer.of(tokenizer.value), bits.value
        for batch in batches:
            rows: list[int] = []
            ids: list[bytes] = []
            size = 0
            for k, content in enumerate(batch.column(1).to_pylist()):
                parts = [p for _, plain, p in _chunks_of(t, content) if plain]
                if parts and _shared(filter_, parts):
                    continue
                rows.append(k)
                coded = b"".join([t.encode(s) if plain else t.special[s] for plain, s in _sections(t, content)])
                ids.append(np.frombuffer(coded, dtype=t.kind).astype("<u4").tobytes())
                size += len(ids[-1])
                if size >= 1 << 20:
                    yield _keyed_ids(batch, rows, ids, n_keys)
                    rows, ids, size = [], [], 0
            if rows:
                yield _keyed_ids(batch, rows, ids, n_keys)

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[2:]]
    return read.mapInArrow(run, ", ".join([*kinds, "ids binary"]))


def _keyed_ids(batch: pa.RecordBatch, rows: list[int], ids: list[bytes], n_keys: int) -> pa.RecordBatch:
    owners = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([*(batch.column(2 + i).take(owners) for i in range(n_keys)), pa.array(ids, pa.binary())],
                                      names=[*(f"_k{i}" for i in range(n_keys)), "ids"])


_PLACES = "_digest binary, _chunk string, _row long, _at int, _kind int"


def _chunks(read: DataFrame, bits, tokenizer) -> DataFrame:
    """A row for every chunk of every row with a shared chunk: digest, place, and the text once per task.  Kind: 0 special token,
    1 first chunk of a stretch, 2 later chunk.  Keys stand in a row's first chunk alone."""
    n_keys = len(read.columns) - 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, filter_ = Tokenizer.of(tokenizer.value), bits.value
        sent: set[bytes] = set()
        for batch in batches:
            numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            places: list[tuple[bytes, bytes, int, int, int, int]] = []
            counts: dict[bytes, int] = {}
            for k, (number, content) in enumerate(zip(numbers, texts)):
                chunks = list(_chunks_of(t, content))
                plain_parts = [p for _, plain, p in chunks if plain]
                if not plain_parts or not _shared(filter_, plain_parts):
                    continue
                last = -1
                for at, (stretch, plain, part) in enumerate(chunks):
                    kind = (1 if stretch != last else 2) if plain else 0
                    last = stretch
                    digest = hashlib.blake2b(part, digest_size=16, salt=b"text" if plain else b"special").digest()
                    counts[digest] = counts.get(digest, 0) + 1
                    places.append((digest, part, number, at, kind, k))
            salts = {d: hashlib.blake2b(d, digest_size=16, salt=numbers[0].to_bytes(16, "little")).digest() for d, n in counts.items() if n >= HOT}
            for a in range(0, len(places), 4096):
                some = places[a : a + 4096]
                digests = [salts.get(p[0], p[0]) for p in some]
                chunks = []
                for d, p in zip(digests, some):
                    chunks.append(None if d in sent else p[1].decode())
                    if len(sent) >= SENT:
                        sent.clear()
                    sent.add(d)
                owner = pa.array([p[5] if p[3] == 0 else None for p in some], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(chunks, pa.string()), pa.array([p[2] for p in some], pa.int64()),
                     pa.array([p[3] for p in some], pa.int32()), pa.array([p[4] for p in some], pa.int32()),
                     *(batch.column(2 + i).take(owner) for i in range(n_keys))],
                    names=["_digest", "_chunk", "_row", "_at", "_kind", *(f"_k{i}" for i in range(n_keys))])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[2:]]
    return read.mapInArrow(cut, ", ".join([_PLACES, *kinds]))


def _encoded(chunks: DataFrame, n_keys: int, tokenizer) -> DataFrame:
    """Ids and marks in place of digest and text; rows come sorted by digest, the text first, so each chunk is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer.of(tokenizer.value)
        last, ids, marks = None, b"", b""
        for batch in batches:
            digests, texts, kinds = (batch.column(i).to_pylist() for i in (0, 1, 4))
            all_ids, all_marks = [], []
            for d, content, kind in zip(digests, texts, kinds):
                if d != last:
                    last, marks = d, b""
                    if kind == 0:
                        ids = t.special[content]
                    else:
                        ids, found = t.chunk(content)
                        marks = np.array(found, dtype="<u2").tobytes()
                all_ids.append(ids)
                all_marks.append(marks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), batch.column(4), pa.array(all_ids, pa.binary()), pa.array(all_marks, pa.binary()),
                 *(batch.column(5 + i) for i in range(n_keys))],
                names=["_row", "_at", "_kind", "_ids", "_marks", *(f"_k{i}" for i in range(n_keys))])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema.fields[5:]]
    met = chunks.repartition("_digest").sortWithinPartitions("_digest", F.col("_chunk").isNull())
    return met.mapInArrow(run, ", ".join(["_row long, _at int, _kind int, _ids binary, _marks binary", *kinds]))


def encode(docs: DataFrame, keys: list[str], text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``keys`` and ``ids`` of every row: the ids of its whole text as little-endian unsigned 32-bit integers (see ``unpacked``)."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(load(path).state())  # the size of the tokenizer file
    bits = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, text, tokenizer))  # FILTER_BITS at most
    read = docs.select(F.monotonically_increasing_id().alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                       *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
    coded = _encoded(_chunks(read, bits, tokenizer), len(keys), tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer.of(tokenizer.value)
        row, joiner, own = None, _Joiner(t), None
        done: list[bytes] = []
        kept: list[pa.RecordBatch] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.concat_arrays([b.column(i) for b in kept]) for i in range(len(keys))), pa.array(done, pa.binary())],
                names=[*(f"_k{i}" for i in range(len(keys))), "ids"])

        def finish() -> None:
            nonlocal size
            joiner.close()
            done.append(np.frombuffer(b"".join(joiner.ids), dtype=t.kind).astype("<u4").tobytes())
            kept.append(own)
            size += len(done[-1])
            joiner.ids = []

        for batch in batches:
            cells = (batch.column(i).to_pylist() for i in range(5))
            for k, (number, _, kind, ids, marks) in enumerate(zip(*cells)):
                if number != row:
                    if row is not None:
                        finish()
                        if size >= 1 << 20 or len(done) >= 1000:
                            yield out()
                            done, kept, size = [], [], 0
                    row = number
                    own = pa.RecordBatch.from_arrays([batch.column(5 + i).slice(k, 1) for i in range(len(keys))], names=[f"_k{i}" for i in range(len(keys))])
                if kind in (0, 1):
                    joiner.close()
                if kind == 0:
                    joiner.ids.append(ids)
                elif kind in (1, 2):
                    joiner.add(ids, np.frombuffer(marks, dtype="<u2").tolist())
        if row is not None:
            finish()
            yield out()

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in coded.schema.fields[5:]]
    placed = coded.repartition("_row").sortWithinPartitions("_row", "_at")
    joined = placed.mapInArrow(run, ", ".join([*kinds, "ids binary"]))
    return joined.unionAll(_alone(read, bits, tokenizer)).withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})


def decode(coded: DataFrame, ids: str = "ids", to: str = "decoded", path: str = TOKENIZER) -> DataFrame:
    """``coded`` with ``to``: the text of its ids (U+FFFD for bytes that are none)."""
    pieces = coded.sparkSession.sparkContext.broadcast(load(path).pieces)
    coded = coded.drop(to)
    at = coded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces.value
        for batch in batches:
            texts = [None if x is None else b"".join([table[i] for i in np.frombuffer(x, dtype="<u4").tolist()]).decode(errors="replace")
                     for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields]
    return coded.mapInArrow(run, ", ".join([*kinds, f"`{to}` string"]))


def unpacked(ids: bytes | None) -> list[int]:
    """Ids of one packed cell."""
    return np.frombuffer(ids or b"", dtype="<u4").tolist()
