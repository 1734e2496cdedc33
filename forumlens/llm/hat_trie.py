"""Phrase collocations by counting word runs in HAT-tries.

Texts are folded (A-Z only) and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``; words are what stands between blanks and tabs.
Every task counts runs of words inside pieces in a trie over task-local word ids: shallow nodes lead by word id to hash
containers of the remaining ids; a container beyond ``BURST`` entries bursts into a node one word deeper.  Beyond ``ENTRIES``
entries the largest subtrees are spilled whole, each as a sorted run of rows (lang, words, count).  The runs of all tasks meet
in the partition of their two-word prefix, where equal phrases are merged.

Counting takes a reading for each length.  A run can only be frequent if the shorter runs in it are, so the second reading
counts just the pairs of words that pass a filter of ``FILTER_BITS`` bits made from the frequent words, and the third the runs of three
whose pairs pass one made from the frequent pairs.  A filter has one size whatever the corpus; what it lets through wrongly is
counted exactly and dropped by its count.

A candidate is a phrase of 2 or 3 words with at least ``least`` occurrences (a).  Each cut of it into a first part (l
occurrences) and a rest (r) scores floor(1000000 a a / (l r)), in whole numbers of 38 digits; the lowest score counts, ties to
the earliest cut.  A candidate inside a longer one with at least half of its occurrences is dropped.

Defined results: a null text is empty; a null language is ``und``; empty texts and texts without words add nothing; repeated
rows count each time; an empty table gives no rows; ties of score go to the larger a, then to the smaller phrase in UTF-8
bytes.  Only ``lang`` and ``text`` are read, so other columns and their names don't matter.  Texts of any length are read
in blocks that end between pieces; only a single piece must fit into a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.operators.ranking import top_per_group
from forumlens.session import freeze

LEAST = 10
FIRST = 2000
BURST = 4096
ENTRIES = 1_000_000
WORD_BITS = 21
FILTER_BITS = 1 << 25
BLOCK = 2 << 20
_MASK = (1 << WORD_BITS) - 1
_BREAK, _BLANK = 10, 32
RUN_SCHEMA = "lang string, w1 string, w2 string, w3 string, n long"


def _byte(b: int) -> int:
    if b in b".,;:!?\n\x0b\x0c\r":
        return _BREAK
    if b in b" \t":
        return _BLANK
    return b + 32 if 65 <= b <= 90 else b


BYTES = bytes(_byte(b) for b in range(256))


class HatTrie:
    """Counts of word runs; a run is three ids of ``WORD_BITS`` bits, 0 for no word.

    Below a first word stands a hash container of the rests of its runs or, once burst, a node: a container for each second word.
    """

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.root: dict[int, dict[int, int] | _Node] = {}
        self.entries = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds the counts of distinct keys."""
        root, new = self.root, 0
        for word, rest, n in zip((keys >> (2 * WORD_BITS)).tolist(), (keys & ((1 << 2 * WORD_BITS) - 1)).tolist(), counts.tolist()):
            box = root.get(word)
            if box is None:
                root[word] = {rest: n}
                new += 1
                continue
            if type(box) is _Node:
                box = box.setdefault(rest >> WORD_BITS, {})
                rest &= _MASK
            if rest in box:
                box[rest] += n
            else:
                box[rest] = n
                new += 1
                if len(box) > self.burst and box is root[word]:
                    root[word] = _burst(box)
        self.entries += new

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes out whole subtrees, the largest first, until at most ``keep`` entries are left: keys and counts of each lot."""
        size = {w: sum(map(len, box.values())) if type(box) is _Node else len(box) for w, box in self.root.items()}
        lot: list[int] = []
        held = 0
        for word in sorted(size, key=size.__getitem__, reverse=True):
            if self.entries <= keep:
                break
            lot.append(word)
            held, self.entries = held + size[word], self.entries - size[word]
            if held >= 1 << 17:
                yield self._take(lot)
                lot, held = [], 0
        if lot:
            yield self._take(lot)

    def _take(self, lot: list[int]) -> tuple[np.ndarray, np.ndarray]:
        prefixes: list[int] = []
        boxes: list[dict[int, int]] = []
        for word in lot:
            box = self.root.pop(word)
            for second, part in box.items() if type(box) is _Node else ((0, box),):
                prefixes.append((word << (2 * WORD_BITS)) | (second << WORD_BITS))
                boxes.append(part)
        rests = np.fromiter(chain.from_iterable(boxes), np.int64)
        counts = np.fromiter(chain.from_iterable(b.values() for b in boxes), np.int64, len(rests))
        return np.repeat(np.array(prefixes, dtype=np.int64), [len(b) for b in boxes]) | rests, counts


class _Node(dict[int, dict[int, int]]):
    """A burst container."""


def _burst(box: dict[int, int]) -> _Node:
    node = _Node()
    for rest, n in box.items():
        node.setdefault(rest >> WORD_BITS, {})[rest & _MASK] = n
    return node


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _bit_places(h: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(n_bits)).astype(np.int64), ((h >> np.uint64(32)) * np.uint64(31) % np.uint64(n_bits)).astype(np.int64)


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b" " + word)


def _passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), dtype=bool)
    for at in _bit_places(h, 8 * len(bits)):
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return out


class _Reader:
    """Words of one task's texts as ids, and the trie that runs of ``length`` of them are counted in.

    A word that the filter rules out has id 0, which no run goes through.
    """

    def __init__(self, length: int, bits: np.ndarray | None, entries: int, burst: int):
        self.length = length
        self.bits = bits
        self.limit = entries
        self.trie = HatTrie(burst)
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, dict[bytes, int]] = {}
        self.names: list[tuple[str, bytes]] = [("", b"")]
        self.hashes: list[int] = [0]
        self.singles = np.zeros(0, dtype=np.int64)  # occurrences of each word, the nodes' own counts
        self.totals: dict[str, int] = {}

    def _number(self, lang: str, words: list[bytes]) -> np.ndarray:
        ids = self.ids.setdefault(lang, {})
        out = list(map(ids.get, words))
        new = [k for k, number in enumerate(out) if number is None]
        hashes = [_word_hash(lang, words[k]) for k in new] if self.length > 1 else []
        fit = _passes(np.array(hashes, dtype=np.uint64), self.bits).tolist() if self.length == 2 else [True] * len(new)
        for j, k in enumerate(new):
            if not fit[j]:
                out[k] = ids[words[k]] = 0
                continue
            out[k] = ids[words[k]] = len(self.names)
            self.names.append((lang, words[k]))
            if self.length == 3:
                self.hashes.append(hashes[j])
        return np.array(out, dtype=np.int64)

    def read(self, lang: str, block: bytes) -> Iterator[pa.RecordBatch]:
        """Counts one block of folded text; yields what has to be spilled."""
        raw = np.frombuffer(block, dtype=np.uint8)
        inside = (raw != _BREAK) & (raw != _BLANK)
        starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        if not len(starts):
            return
        sizes = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 - starts
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
        if len(self.names) + len(words.dictionary) > _MASK:
            yield from self.flush()
        codes = self._number(lang, words.dictionary.to_pylist())[words.indices.to_numpy()]
        breaks = np.flatnonzero(raw == _BREAK)
        piece = np.searchsorted(breaks, starts)
        if self.length == 1:
            self.totals[lang] = self.totals.get(lang, 0) + len(codes)
            more = np.bincount(codes, minlength=len(self.names))
            more[: len(self.singles)] += self.singles
            self.singles = more
            return
        keys = self._runs(codes, piece)
        if len(keys):
            self.trie.add(*np.unique(keys, return_counts=True))
        if self.trie.entries > self.limit:
            yield from self._write(self.trie.spill(self.limit // 2))

    def _runs(self, ids: np.ndarray, piece: np.ndarray) -> np.ndarray:
        two = (piece[1:] == piece[:-1]) & (ids[1:] > 0) & (ids[:-1] > 0)
        if self.length == 2:
            return (ids[:-1][two] << (2 * WORD_BITS)) | (ids[1:][two] << WORD_BITS)
        h = np.array(self.hashes, dtype=np.uint64)[ids]
        two[two] = _passes(_pair_hash(h[:-1][two], h[1:][two]), self.bits)
        three = np.flatnonzero(two[:-1] & two[1:])
        return (ids[three] << (2 * WORD_BITS)) | (ids[three + 1] << WORD_BITS) | ids[three + 2]

    def _write(self, lots: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Each lot as a run of rows sorted by language and words."""
        for keys, counts in lots:
            parts = [keys >> (2 * WORD_BITS), (keys >> WORD_BITS) & _MASK, keys & _MASK]
            used = np.flatnonzero(np.bincount(np.concatenate(parts), minlength=1)).tolist()
            order = sorted(used, key=self.names.__getitem__)
            rank = np.zeros(len(self.names), dtype=np.int64)
            rank[order] = np.arange(len(order))
            parts = [rank[p] for p in parts]
            sort = np.argsort((parts[0] << (2 * WORD_BITS)) | (parts[1] << WORD_BITS) | parts[2])
            langs = pa.array([self.names[i][0] for i in order], pa.string())
            words = pa.array([self.names[i][1] if i else None for i in order], pa.binary()).cast(pa.string())
            for at in range(0, len(sort), 1 << 16):
                some = sort[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(parts[0][some])), *(words.take(pa.array(p[some])) for p in parts), pa.array(counts[some])],
                    names=["lang", "w1", "w2", "w3", "n"])

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Spills everything and forgets the words."""
        yield from self._write(self.trie.spill(0))
        met = np.flatnonzero(self.singles)
        for at in range(0, len(met), 1 << 16):
            some = met[at : at + (1 << 16)]
            yield from self._write([(some << (2 * WORD_BITS), self.singles[some])])
        for lang, n in self.totals.items():
            yield pa.RecordBatch.from_pylist([{"lang": lang, "n": n}], schema=pa.schema(
                [("lang", pa.string()), *((w, pa.string()) for w in ("w1", "w2", "w3")), ("n", pa.int64())]))
        self.forget()


def _blocks(texts: list[str]) -> Iterator[bytes]:
    """Folded texts in blocks of about ``BLOCK`` bytes that end between pieces."""
    data = "\n".join(texts).encode().translate(BYTES)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > BLOCK:
            end = data.rfind(b"\n", at, at + BLOCK) + 1 or data.find(b"\n", at + BLOCK) + 1 or len(data)
        yield data[at:end]
        at = end


def runs(docs: DataFrame, length: int, bits: np.ndarray | None = None, entries: int = ENTRIES, burst: int = BURST) -> DataFrame:
    """Spilled runs of all tasks; for single words, also a row without words for the total of a language."""
    shared = None if bits is None else docs.sparkSession.sparkContext.broadcast(bits)  # one size whatever the corpus

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(length, None if shared is None else shared.value, entries, burst)
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for block in _blocks(texts):
                    yield from reader.read(lang, block)
        yield from reader.flush()

    read = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return read.mapInArrow(count, RUN_SCHEMA)


def merged(spilled: DataFrame, least: int) -> DataFrame:
    """Phrases with ``least`` occurrences or more; runs meet by their prefix of two words and are merged there."""
    placed = spilled.repartition("lang", "w1", "w2")
    return placed.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def filter_of(phrases: DataFrame, n_bits: int = FILTER_BITS) -> np.ndarray:
    """Bits of all rows (lang, w1, and w2 for pairs): ``n_bits`` bits, however many the rows are."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, *words = (column.to_pylist() for column in batch.columns)
            hashes = [np.array([_word_hash(g, w.encode()) for g, w in zip(langs, ws)], dtype=np.uint64) for ws in words]
            at = np.concatenate(_bit_places(hashes[0] if len(hashes) == 1 else _pair_hash(*hashes), n_bits))
            cell, where = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(cell), dtype=np.int64)
            np.bitwise_or.at(bits, where, np.int64(1) << (at & 63))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits)], names=["cell", "bits"])

    rows = phrases.mapInArrow(places, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(n_bits // 64, dtype="<i8")
    got = rows.toArrow()  # at most n_bits / 64 rows
    out[got.column("cell").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _score(l: str, r: str) -> Column:
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    return F.expr(f"CAST(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) AS DECIMAL(38,0)) "
                  f"div CAST(CAST({l} AS DECIMAL(18,0)) * CAST({r} AS DECIMAL(18,0)) AS DECIMAL(38,0))")


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, n_bits: int = FILTER_BITS, **trie: int) -> DataFrame:
    """The ``first`` best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    words = freeze(merged(runs(docs, 1, **trie), least), "words")
    total = words.filter(F.col("w1").isNull()).select("lang", F.col("n").alias("total"))
    single = words.filter(F.col("w1").isNotNull()).select("lang", "w1", F.col("n").alias("f"))
    bits = filter_of(single.select("lang", "w1"), n_bits)
    pairs = freeze(merged(runs(docs, 2, bits, **trie), least).select("lang", "w1", "w2", F.col("n").alias("a")), "frequent_pairs")
    bits = filter_of(pairs.select("lang", "w1", "w2"), n_bits)
    triples = freeze(merged(runs(docs, 3, bits, **trie), least), "triples")

    # Pairs with the occurrences of both words.
    pairs = freeze(
        pairs.join(single.withColumnRenamed("f", "l"), ["lang", "w1"])
        .join(single.select("lang", F.col("w1").alias("w2"), F.col("f").alias("r")), ["lang", "w2"])
        .select("lang", "w1", "w2", "a", "l", "r"), "pairs")
    head = pairs.select("lang", "w1", "w2", F.col("a").alias("l2"), F.col("l").alias("l1"))
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = freeze(
        triples.withColumnRenamed("n", "a").join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        .withColumn("s1", _score("l1", "r1")).withColumn("s2", _score("l2", "r2"))
        .withColumn("cut", F.when(F.col("s1") <= F.col("s2"), 1).otherwise(2))
        .select("lang", "w1", "w2", "w3", "a", *(F.when(F.col("cut") == 1, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(c) for c in "lrs")), "scored_triples")

    # The most frequent longer candidate around each pair.
    around = (
        triples.select("lang", "w1", "w2", "a")
        .unionAll(triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
        .groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer")))
    kept = (
        pairs.join(around, ["lang", "w1", "w2"], "left")
        .filter(F.coalesce(100 * F.col("longer") < 50 * F.col("a"), F.lit(True)))
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("l", "r").alias("score")))
    both = kept.unionAll(triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", F.col("s").alias("score")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    best = top_per_group(both, "lang", order, first, "rank")
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
