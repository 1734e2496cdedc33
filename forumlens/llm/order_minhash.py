"""Near duplicates by Order MinHash, checked by a banded alignment.

A text becomes its sequence of five-word shingles; the n-th occurrence of a shingle carries the
label n, so all labelled shingles of a text differ.  Each of ``SKETCHES`` random orders picks the
``TUPLE`` least labelled shingles and keeps them in text order: two texts agree on a sketch only if
they share these shingles and their order.  A text that repeats shingles has the sketches of its first occurrences too,
with the same keys: it also meets texts that have each shingle once.  Texts that agree on a sketch are candidates.  A candidate
pair is verified by aligning its labelled shingles: as they are unique, the longest common
subsequence is the longest rising chain of matched positions, searched only within the band that a
pair of the wanted similarity cannot leave.  Similarity is aligned / (all - aligned), a Jaccard
similarity that heeds order, over all occurrences or over first occurrences, whichever is more.

Texts with equal words are one node from the start.  A bucket of more than ``DIRECT`` nodes is
worked off by leaders: the least node is compared with all members outside its component and
leaves; later rounds take 16, 4,096 and more leaders.  After the first round the shingles that only one
node of the open buckets has are counted, and every node gets a bitmap of ``BITS`` bits of its shingles: a bit that the other
node lacks is a shingle it lacks.  Both bound the similarity of a pair from above, and pairs out of reach are not compared.
Nodes meet in many buckets: the least bucket that the leader leads makes the pair, not every bucket.
Nodes with the smallest share of shingles of their own lead: they are the ones that near copies have in common.  A bucket is closed when its members form one component or all its cross pairs have been
compared or ruled out, so no candidate pair of different components stays untested, while a group of n near
copies costs about n comparisons.

Defined results: null text: never a duplicate.  Text without words: a duplicate only of the same
text.  Fewer than five words: one shingle of all of them.  Repeated rows and equal texts are one
class.  The class id is the least doc_id of the class (nulls aside).
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.text import WORD_BYTES, same
from forumlens.operators.cluster import components
from forumlens.session import freeze

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 16  # at similarity 0.8 about half of the sketches agree: a miss in 100,000
TUPLE = 3
DIRECT = 4
BITS = 512
SLICE = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SEEDS = np.array([(0xD1B54A32D192ED03 * (i + 1)) & (2**64 - 1) for i in range(SKETCHES)], dtype=_U)
_STEPS = np.array([(0x8CB92BA72F3D8DD7 * (2 * i + 1)) & (2**64 - 1) for i in range(SHINGLE)], dtype=_U) | _U(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for every 64-bit number."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables() -> list[np.ndarray]:
    if not _powers:
        inverse = pow(_BASE, -1, 2**64)
        for base in (_BASE, inverse):
            steps = np.full(SLICE + 1, base, dtype=_U)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def _slice_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of up to SLICE bytes in which all gaps are spaces."""
    power, inverse = _tables()
    b = np.frombuffer(raw, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = b != 32
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(b) + 1, dtype=_U)
    np.cumsum(b * power[: len(b)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word; memory beyond eight bytes a word is bounded by SLICE."""
    raw, at, parts = text.encode().translate(WORD_BYTES), 0, []
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):
            cut = raw.rfind(b" ", at, end + 1)
            if cut <= at:  # a word longer than a slice
                cut = raw.find(b" ", at + 1)
                cut = len(raw) if cut < 0 else cut
                if cut - at > SLICE:
                    word = raw[at:cut].strip()
                    parts.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), dtype=_U))
                    at = cut
                    continue
            end = cut
        parts.append(_slice_hashes(raw[at:end])[1])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=_U)


def batch_hashes(texts: list[str]) -> Iterator[np.ndarray]:
    """``word_hashes`` of many texts, short ones joined into slices."""
    held: list[bytes] = []
    size = 0

    def emit():
        offsets = np.cumsum([0] + [len(x) + 1 for x in held])
        starts, hashes = _slice_hashes(b" ".join(held))
        cuts = np.searchsorted(starts, offsets)
        for k in range(len(held)):
            yield hashes[cuts[k] : cuts[k + 1]]

    for text in texts:
        raw = text.encode()
        if size + len(raw) + 1 > SLICE and held:
            yield from emit()
            held, size = [], 0
        if len(raw) + 1 > SLICE:
            yield word_hashes(text)
            continue
        held.append(raw.translate(WORD_BYTES))
        size += len(raw) + 1
    if held:
        yield from emit()


def shingles(hashes: np.ndarray) -> np.ndarray:
    k = min(SHINGLE, len(hashes))
    if not k:
        return hashes
    n = len(hashes) - k + 1
    out = np.full(n, k, dtype=_U)
    for i in range(k):
        out = out + hashes[i : i + n] * _STEPS[i]
    return mix(out)


def occurrence(values: np.ndarray) -> np.ndarray:
    """How often each value stood before in the sequence."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.ones(len(values), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.arange(len(values))
    out = np.empty(len(values), dtype=np.int64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


def sketch(values: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """One key per random order: the least labelled shingles, in text order."""
    n, take = len(values), min(TUPLE, len(values))
    if not n:
        return np.zeros(0, dtype=_U)
    rows = max(1, (1 << 18) // n)
    keys = []
    for at in range(0, SKETCHES, rows):
        seeds = _SEEDS[at : at + rows, None]
        ranks = mix(marked[None, :] ^ seeds)
        least = np.argpartition(ranks, take - 1, axis=1)[:, :take]
        least.sort(axis=1)
        key = np.broadcast_to(seeds[:, 0], len(seeds)).copy()
        for i in range(take):
            key = mix(key + values[least[:, i]] * _STEPS[i])
        keys.append(key)
    return np.concatenate(keys)


def _fingerprint(hashes: np.ndarray, text: str) -> bytes:
    if not len(hashes):
        return hashlib.blake2b(text.encode(), digest_size=16, person=b"no words").digest()
    at = np.arange(len(hashes), dtype=_U)
    one = mix(hashes + at * _U(_BASE)).sum(dtype=_U)
    two = mix((hashes ^ _U(0xA0761D6478BD642F)) + at * _U(0xE7037ED1A0B428DB)).sum(dtype=_U)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


_SKETCHED = "doc_id {id}, th long, node binary, n long, nd long, keys array<long>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).to_pylist()
        nodes, ns, nds, keys = [], [], [], []
        for text, hashes in zip(texts, batch_hashes(texts)):
            values = shingles(hashes)
            marked, first = labelled(values)
            nodes.append(_fingerprint(hashes, text))
            ns.append(len(values))
            nds.append(int(first.sum()))
            found = sketch(values, marked)
            if not first.all():
                found = np.unique(np.concatenate((found, sketch(values[first], marked[first]))))
            keys.append(found.view(np.int64))
        offsets = np.cumsum([0] + [len(k) for k in keys]).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(ns, pa.int64()),
             pa.array(nds, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["doc_id", "th", "node", "n", "nd", "keys"],
        )


def _chain(a: np.ndarray, b: np.ndarray, band: int, least: float) -> int:
    """Length of the longest common subsequence of two sequences of unique values within a band.

    Fewer than ``least`` matches can't become as many in order; they count as none.
    """
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    j = order[at]
    hit = (b[j] == a) & (np.abs(np.arange(len(a)) - j) <= band)
    row = j[hit]
    if len(row) < least:
        return 0
    if (np.diff(row) > 0).all():
        return len(row)
    tails: list[int] = []
    for x in row.tolist():
        k = bisect.bisect_left(tails, x)
        if k == len(tails):
            tails.append(x)
        else:
            tails[k] = x
    return len(tails)


def labelled(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles with their occurrence mixed in, so all differ, and whether each is a first occurrence."""
    seen = occurrence(values)
    return mix(values + seen.astype(_U) * _U(0xC2B2AE3D27D4EB4F)), seen == 0


def aligned(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], threshold: float) -> float:
    """Aligned share of two labelled sequences; exact from ``threshold`` on, 0 where it is out of reach."""
    best, sides = 0.0, [(one[0], two[0])]
    if not (one[1].all() and two[1].all()):
        sides.append((one[0][one[1]], two[0][two[1]]))
    for a, b in sides:
        total = len(a) + len(b)
        if not len(a) or not len(b) or min(len(a), len(b)) < threshold * max(len(a), len(b)):
            continue
        # At most this many shingles stay unmatched, so no match lies further off the diagonal.
        band = int((1 - threshold) / (1 + threshold) * total) + 1
        common = _chain(a, b, band, threshold / (1 + threshold) * total - 1e-6)
        best = max(best, common / (total - common))
    return best


def similarity(one: np.ndarray, two: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Aligned share of two shingle sequences; exact from ``threshold`` on."""
    return aligned(labelled(one), labelled(two), threshold)


def _label_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as labelled shingles, so that a text of many pairs is hashed once; one row at a time."""
    for batch in batches:
        for node, text in zip(batch.column(0), batch.column(1)):
            values, first = labelled(shingles(word_hashes(text.as_py())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([node.as_py()], pa.binary()), pa.array([values.tobytes()], pa.binary()),
                 pa.array([np.packbits(first).tobytes()], pa.binary())], names=["node", "values", "firsts"])


def _stored(values: bytes, firsts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(values, dtype=_U)
    return found, np.unpackbits(np.frombuffer(firsts, dtype=np.uint8), count=len(found)).astype(bool)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                1 - aligned(_stored(a.as_py(), af.as_py()), _stored(b.as_py(), bf.as_py()), threshold)
                for a, af, b, bf in zip(*(batch.column(c) for c in range(2, 6)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["i", "j", "distance"]
            )

    return run


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), node (fingerprint of the words), sizes and sketch keys."""
    source = docs.filter(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th"), "text")
    return source.mapInArrow(_sketch_batches, _SKETCHED.format(id=docs.schema["doc_id"].dataType.simpleString()))


def _single_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, values, firsts in zip(*(batch.column(c) for c in range(3))):
            keys, first = _stored(values.as_py(), firsts.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array([node.as_py()] * len(keys), pa.binary()), pa.array(first.astype(np.int64)), pa.array(keys.view(np.int64))],
                names=["node", "one", "key"])


def _singles(texts: DataFrame) -> DataFrame:
    """Per node: u and ud, its labelled and its distinct shingles that no other node of ``texts`` has."""
    keys = texts.mapInArrow(_single_batches, "node binary, one long, key long")
    alone = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("_n"), F.min("one").alias("one")).filter("c = 1")
    return alone.groupBy("_n").agg(F.count(F.lit(1)).alias("_u"), F.sum("one").alias("_ud"))


def _bit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of a node's labelled shingles and of its first occurrences, and how many bits they have."""
    kind = pa.list_(pa.int64())
    for batch in batches:
        words: tuple[list[np.ndarray], ...] = ([], [])
        sizes: tuple[list[int], ...] = ([], [])
        for values, firsts in zip(batch.column(1), batch.column(2)):
            keys, first = _stored(values.as_py(), firsts.as_py())
            for k, some in enumerate((keys, keys[first])):
                bits = np.zeros(BITS, dtype=bool)
                bits[(some % _U(BITS)).astype(np.int64)] = True
                words[k].append(np.packbits(bits, bitorder="little").view("<i8"))
                sizes[k].append(int(bits.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, kind) for x in words), *(pa.array(x, pa.int64()) for x in sizes)], names=["node", "b", "bd", "p", "pd"])


def _within_reach(threshold: float):
    """Whether two nodes can be as similar as that: shingles that only one of them has, or whose bit the other lacks, are not shared."""
    share = (threshold - 1e-9) / (1 + threshold)

    def reach(n: str, u: str, b: str, p: str):
        word = lambda c, k: F.get(F.col(c), F.lit(k))
        both = reduce(lambda x, y: x + y, [F.bit_count(word(b, k).bitwiseAND(word(f"{b}2", k))) for k in range(BITS // 64)])
        enough = share * (F.col(n) + F.col(f"{n}2"))
        alone = F.least(F.col(n) - F.col(u), F.col(f"{n}2") - F.col(f"{u}2")) >= enough
        # A shingle whose bit is not among the common ones is lacking on the other side.
        mapped = F.least(F.col(n) - F.col(p), F.col(f"{n}2") - F.col(f"{p}2")) + both >= enough
        return alone & F.coalesce(mapped, F.lit(True))

    plain = (F.col("n") == F.col("nd")) & (F.col("n2") == F.col("nd2"))
    return reach("n", "u", "b", "p") | (~plain & reach("nd", "ud", "bd", "pd"))


def _meetings(large: DataFrame, led: DataFrame) -> DataFrame:
    """The rows of ``large`` with all buckets that their node is in (mem), those that it leads (lead), 32 at most, and whether it leads this one."""
    both = large.withColumn("_led", F.lit(False)).unionByName(led.withColumn("_led", F.lit(True)), allowMissingColumns=True)
    listed = lambda which: F.collect_list(F.when(which, F.col("bucket"))).over(Window.partitionBy("node"))
    both = both.withColumns({"mem": listed(~F.col("_led")), "lead": listed(F.col("_led"))})
    return both.filter("not _led").withColumn("leads", F.array_contains("lead", F.col("bucket"))).drop("_led")


def _pairs(left: DataFrame, right: DataFrame, threshold: float, extra: list[str], once: str, here: str = "true") -> DataFrame:
    renamed = [F.col(c).alias(f"{c}2") for c in ("bucket", "node", "n", "nd", "u", "ud", "b", "bd", "p", "pd", "label", *extra)]
    on = (F.col("bucket") == F.col("bucket2")) & (F.col("label") != F.col("label2")) & F.expr(once) & _within_reach(threshold) & F.expr(here)
    return left.join(right.select(*renamed), on).select(
        F.least("node", "node2").alias("i"), F.greatest("node", "node2").alias("j"))


def _leader_pairs(large: DataFrame, threshold: float) -> DataFrame:
    """Members with leaders.  Nodes meet in many buckets; the least one that the leader leads makes the pair, of two leaders the lesser's."""
    least = "bucket = array_min(array_intersect(lead2, mem))"
    return _pairs(large, large.filter("leads"), threshold, ["lead"], "NOT leads OR node2 < node", least)


def _candidates(members: DataFrame, leaders: int, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """Pairs to compare now, and the members of the buckets that stay open; None if all are closed."""
    share = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"))
    sizes = share.groupBy("bucket").agg(F.sum("c").alias("size"), F.sum(F.col("c") * F.col("c")).alias("same"))
    cross = (F.col("size") * F.col("size") - F.col("same")) / 2
    sizes = sizes.filter(cross > 0).select(F.col("bucket").alias("_b"), (cross <= F.col("size") * (DIRECT - 1) / 2).alias("direct"))
    live = freeze(members.join(sizes, F.col("bucket") == F.col("_b")).drop("_b"), "live")
    if live.isEmpty():
        return None
    direct, large = live.filter("direct"), live.filter("not direct")
    first = Window.partitionBy("bucket").orderBy(F.col("u") / F.col("n"), "node")
    led = freeze(large.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= leaders).select("bucket", "node"), "leaders")
    large = freeze(_meetings(large.drop("direct"), led), "meetings")
    found = _pairs(direct, direct, threshold, [], "node2 < node").unionByName(_leader_pairs(large, threshold)).distinct()
    return found, large.filter("not leads").drop("mem", "lead", "leads")


def near_links(docs: DataFrame, sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame | None:
    """Component of every node that has a verified link: node, label; None if there is no link."""
    nodes = sketched.groupBy("node").agg(
        F.min(F.struct("doc_id", "th")).alias("at"), F.first("n").alias("n"), F.first("nd").alias("nd"), F.first("keys").alias("keys"))
    entries = freeze(nodes.select("node", "n", "nd", F.explode(F.array_distinct("keys")).alias("bucket")), "buckets")
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select(F.col("bucket").alias("_b"))
    members = freeze(entries.join(shared, F.col("bucket") == F.col("_b"), "left_semi"), "members")
    used = members.select("node").distinct()
    at = nodes.select("node", "at.doc_id", "at.th").join(used, "node", "left_semi")
    at = at.select("node", F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    texts = freeze(
        docs.select("doc_id", "text", F.xxhash64("text").alias("th")).join(at, same(["doc_id", "th"], ["_id", "_th"]))
        .select("node", "text").dropDuplicates(["node"]).mapInArrow(_label_batches, "node binary, values binary, firsts binary"), "texts")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("array<long>")
    members = members.withColumns({"label": F.col("node"), "u": zero, "ud": zero, "b": none, "bd": none, "p": zero, "pd": zero})
    labels, links, tested, leaders = None, None, None, 1
    while (step := _candidates(members, leaders, threshold)) is not None:
        fresh, members = step
        if tested is not None:
            fresh = fresh.join(tested, ["i", "j"], "left_anti")
        fresh = freeze(fresh, "pairs")
        with_texts = (
            fresh.join(texts.select(F.col("node").alias("i"), F.col("values").alias("v1"), F.col("firsts").alias("f1")), "i")
            .join(texts.select(F.col("node").alias("j"), F.col("values").alias("v2"), F.col("firsts").alias("f2")), "j")
            .select("i", "j", "v1", "f1", "v2", "f2")
        )
        checked = with_texts.mapInArrow(_verify(threshold), "i binary, j binary, distance double")
        passed = freeze(checked.filter(F.col("distance") <= 1 - threshold + 1e-9), "links")
        tested = fresh if tested is None else tested.unionByName(fresh)
        if not passed.isEmpty():
            links = passed if links is None else links.unionByName(passed)
            labels = freeze(components(links, 1.0).select(F.col("group").alias("node"), F.col("cluster").alias("label")), "labels")
            members = members.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        if leaders == 1:
            # What is left are large groups: nodes that differ too much from all others of these leave them.
            there = members.select(F.col("node").alias("_m")).distinct()
            left = freeze(texts.join(there, F.col("node") == F.col("_m"), "left_semi"), "open_texts")
            single = freeze(_singles(left), "singles")
            bits = left.mapInArrow(_bit_batches, "node binary, b array<long>, bd array<long>, p long, pd long")
            members = members.drop("u", "ud", "b", "bd", "p", "pd").join(bits, "node").join(single, F.col("node") == F.col("_n"), "left")
            members = members.withColumns({"u": F.coalesce("_u", zero), "ud": F.coalesce("_ud", zero)}).drop("_n", "_u", "_ud")
            members = members.filter(
                (F.col("n") - F.col("u") >= (threshold - 1e-9) * F.col("n")) | (F.col("nd") - F.col("ud") >= (threshold - 1e-9) * F.col("nd")))
        leaders *= 16 if leaders == 1 else 256
    return labels


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, th (hash of its text), class_id, class_size, keep."""
    docs = docs.select("doc_id", "text")
    sketched = freeze(sketches(docs), "sketches")
    labels = near_links(docs, sketched, threshold)
    rows = sketched.select("doc_id", "th", "node")
    if labels is None:
        rows = rows.withColumn("label", F.col("node"))
    else:
        rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th").alias("th"))
    classes = rows.groupBy("label").agg(F.min(key).alias("best"), F.count(F.lit(1)).alias("class_size"))
    out = rows.join(classes, "label").select(
        "doc_id", "th", F.col("best.id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("th") == F.col("best.th"))).alias("keep"))
    alone = docs.filter(F.col("text").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("th"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("keep"))
    return out.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class stays, the one with the least doc_id; rows of null text all stay."""
    kept = near_duplicates(docs, threshold).filter(F.col("keep") & F.col("th").isNotNull())
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    hashed = docs.withColumn("_of", F.xxhash64("text"))
    one = hashed.filter(F.col("text").isNotNull()).join(kept, same(["doc_id", "_of"], ["_id", "_th"]), "left_semi")
    return one.dropDuplicates(["doc_id", "_of"]).unionByName(hashed.filter(F.col("text").isNull())).drop("_of")
