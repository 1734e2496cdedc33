"""Importance resampling of documents towards a target's distribution of hashed word runs.

Features of a text are its runs of 1 to 3 words, hashed by crc32 into ``BUCKETS`` buckets.  Two sums of bucket counts, over
the documents and over the target, give every bucket a gain, floor(1000 ln of the smoothed ratio of shares); a document's weight is the
sum of the gains of its features and its score adds Gumbel noise made from its id, so the highest scores are a draw without
replacement.

Weights are scored by arrays: words are hashed once per distinct word, the crc32 of a run is put together from those of its
words by table lookups, and gains are gathered and summed per document.

The cutoff is found by bracketing.  A mergeable quantile sketch proposes a score range that should hold the cutoff; an
exact count of the scores above it and in it confirms that, or the range is widened on the side where it failed.  Only rows
within the range are sorted, to find the very row where the draw ends.  Ranks are then given to drawn rows alone.

Defined results: a null or empty text has no features and weight 0; a null id counts as an empty one; equal scores
are drawn by smaller id (null first); repeated rows are rows of their own, each drawn and ranked by itself; with no eligible document, or an
empty table, nothing is drawn; an empty target is one without features.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.text import WORD_BYTES
from forumlens.operators.ranking import exact_rank
from forumlens.session import freeze

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PER_CENT = 5
SEED = "42"
# Sketch: rank error of one part in ACCURACY; the first bracket is MARGIN such errors wide on either side.
ACCURACY = 10_000
MARGIN = 2
# Runs whose further words have more bytes than this are hashed one by one instead of by tables.
TABLED = 64
BLOCK = 2 << 20


def _crc_step() -> np.ndarray:
    """crc32 registers after one zero byte, for each of the 32 bits set alone."""
    return _after_zero(np.uint32(1) << np.arange(32, dtype=np.uint32))


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_TABLE = _byte_table()


def _after_zero(register: np.ndarray) -> np.ndarray:
    return (register >> np.uint32(8)) ^ _TABLE[register & np.uint32(255)]


def _shift_tables() -> np.ndarray:
    """[n, k, b]: what byte k of value b of a crc32 becomes after n more bytes; it is linear, so the four are xored."""
    out = np.zeros((TABLED + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(TABLED):
        out[n + 1] = _after_zero(out[n])
    return out


_SHIFT = _shift_tables()


def _joined(crc: np.ndarray, further: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of texts with ``crc`` followed by ``size`` bytes that alone have the crc32 ``further``."""
    out = further.copy()
    for k in range(4):
        out ^= _SHIFT[size, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def features(texts: list[str | None], longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Crc32 of every run of 1 to ``longest`` words, the text of each, and the number of words of each text."""
    folded = [(t or "").encode().translate(WORD_BYTES) for t in texts]
    raw = np.frombuffer(b" ".join(folded) + b" ", dtype=np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in folded])
    inside = raw != 32
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    sizes = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 - starts
    owner = np.searchsorted(ends_of, starts, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
    words = coded.dictionary.to_pylist()
    index = coded.indices.to_numpy()
    alone = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)[index]
    after = np.array([zlib.crc32(b" " + w) for w in words], dtype=np.uint32)[index]
    crcs, owners = [alone], [owner]
    run = alone
    for n in range(1, longest):
        if len(starts) <= n:
            break
        run, extra = run[:-1], sizes[n:] + 1
        run = _joined(run, after[n:], np.minimum(extra, TABLED))
        for at in np.flatnonzero(extra > TABLED).tolist():
            run[at] = zlib.crc32(b" ".join([words[i] for i in index[at : at + n + 1]]))
        whole = owner[n:] == owner[: len(run)]
        crcs.append(run[whole])
        owners.append(owner[: len(run)][whole])
    return np.concatenate(crcs), np.concatenate(owners), n_words


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about ``BLOCK`` characters."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= BLOCK:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket: tasks add up their arrays, Spark adds up the tasks' rows, ``buckets`` numbers return."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, z in _slices(texts):
                total += np.bincount(features(texts[a:z], longest)[0] % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket, in doubles."""
    s, t, buckets = source.astype(np.float64), target.astype(np.float64), len(source)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, keys: list[str], text: str = "text", longest: int = LONGEST) -> DataFrame:
    """``keys`` with n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    names = [f"_k{i}" for i in range(len(keys))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            for a, z in _slices(texts):
                crcs, owner, n_words = features(texts[a:z], longest)
                weight = np.zeros(z - a, dtype=np.int64)
                np.add.at(weight, owner, gain[crcs % np.uint32(len(gain))])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, z - a) for i in range(len(names))), pa.array(n_words.astype(np.int64)),
                     pa.array(np.bincount(owner, minlength=z - a).astype(np.int64)), pa.array(weight)],
                    names=[*names, "n_words", "n_features", "weight"])

    read = docs.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(text).alias("text"))
    kinds = [f"`{n}` {read.schema[n].dataType.simpleString()}" for n in names]
    out = read.mapInArrow(score, ", ".join([*kinds, "n_words long", "n_features long", "weight long"]))
    return out.withColumnsRenamed(dict(zip(names, keys)))


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)), with u from the first 32 bits of the id's sha256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def cutoff(rows: DataFrame, n: int, of: int, score: str = "score", tie: str = "doc_id", margin: int = MARGIN) -> tuple[int, object]:
    """Score and tie value of the n-th of ``of`` rows by score descending, tie ascending; 1 <= n <= of."""
    lowest = max(0.0, 1 - n / of - margin / ACCURACY)
    highest = min(1.0, 1 - n / of + margin / ACCURACY)
    low, high = rows.agg(F.percentile_approx(score, [lowest, highest], ACCURACY).alias("q")).first()["q"]
    wider = max(1, high - low)
    while True:
        seen = rows.agg(F.count_if(F.col(score) > high).alias("above"), F.count_if(F.col(score).between(low, high)).alias("inside"),
                        F.min(score).alias("least"), F.max(score).alias("most")).first()
        if seen["above"] >= n:
            high = min(high + wider, seen["most"])
        elif seen["above"] + seen["inside"] < n:
            low = max(low - wider, seen["least"])
        else:
            break
        wider *= 4
    bracket = rows.filter(F.col(score).between(low, high)).select(score, tie)
    place = exact_rank(bracket, [F.col(score).desc(), F.col(tie).asc()], (), "_place")
    return tuple(place.filter(F.col("_place") == n - seen["above"]).select(score, tie).first())


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, least_words: int = LEAST_WORDS, seed: str = SEED,
             doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every document with n_features, weight, score and, if drawn, its rank."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    scored = weigh(docs, gain, [doc_id], text).withColumn("score", F.col("weight") + gumbel(F.col(doc_id), seed))
    scored = freeze(scored, "weights")
    eligible = scored.filter(F.col("n_words") >= least_words)
    of = eligible.count()
    n = per_cent * of // 100
    columns = [doc_id, "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not n:
        return scored.select(*columns, none)
    last, tie = cutoff(eligible, n, of, tie=doc_id)
    # Up to and with the last row of the draw; of its repeats, ranks beyond n are taken back.
    same = F.col(doc_id).isNull() if tie is None else F.coalesce(F.col(doc_id) <= F.lit(tie), F.lit(True))
    inside = (F.col("n_words") >= least_words) & ((F.col("score") > last) | ((F.col("score") == last) & same))
    drawn = exact_rank(scored.filter(inside).select(*columns), [F.col("score").desc(), F.col(doc_id).asc()], (), "rank")
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return drawn.unionByName(scored.filter(~inside).select(*columns, none))
