"""Exact top-k inner products by histogram selection.

Vectors become integers and are packed into blocks.  The stated queries are packed too, and each
block of candidates meets each block of queries of its dimension once per pass:

1. each pass counts the scores of every query in ``BINS`` bins of its current range and sums the counts
   over all blocks; the bin that holds the k-th score is the next range, until a bin is one integer.
   Queries whose k-th score is known (width 0) rest while wider ones go on;
2. the last pass returns what lies above the k-th score, and of the ties at it the k least ids of each
   block; ranks by (score, id) settle them.

A pass sends counts, never scores; the last one at most k ties a block and query beyond the k-1 rows
above the k-th score.  Scores are int64, computed in float64 where all sums stay exactly representable.

Defined results: vectors that are null, empty or hold null or non-finite components take no part; rows
that repeat a vec_id are one vector (the least); vectors of other dimensions than the query's are no
candidates; fewer than k candidates: all of them; null vec_ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import freeze

SCALE = 64
BINS = 512
QUERY_BLOCK = 512
BLOCK = 4096
SALTS = 16
_PACKED = "dim int, block long, ids binary, vecs binary"


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id, v: components as integers; only vectors that take part."""
    x = F.col("embedding")
    fine = x.isNotNull() & (F.size(x) > 0) & F.col("vec_id").isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(float("inf"))))
    whole = embeddings.select("vec_id", "embedding").filter(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"))
    return whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def _bytes(vecs: np.ndarray) -> bytes:
    """Components in the narrowest integers that hold them all."""
    most = max(int(vecs.max(initial=0)), -int(vecs.min(initial=0)) - 1)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    return vecs.astype(kind).tobytes()


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    def emit(dim, ids, vecs):
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([int(ids[0])], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
             pa.array([_bytes(vecs)], pa.binary())], names=["dim", "block", "ids", "vecs"])

    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        dims = np.asarray(lists.value_lengths())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(dims)))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            vecs = flat[(starts[at][:, None] + np.arange(dim)[None, :])].astype(np.int64)
            parts = held.setdefault(int(dim), [])
            parts.append((ids[at].astype(np.int64), vecs))
            if sum(len(p[0]) for p in parts) >= size:
                ids2, vecs2 = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                whole = len(ids2) // size * size
                for k in range(0, whole, size):
                    yield emit(int(dim), ids2[k : k + size], vecs2[k : k + size])
                held[int(dim)] = [(ids2[whole:], vecs2[whole:])]
    for dim, parts in held.items():
        ids2, vecs2 = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if len(ids2):
            yield emit(dim, ids2, vecs2)


def packed(vectors: DataFrame, size: int) -> DataFrame:
    return vectors.mapInArrow(lambda batches: _pack(batches, size), _PACKED)


def _matrix(dim: int, n: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"i{len(raw) // (n * dim)}").reshape(n, dim).astype(np.int64)


def _scores(queries: np.ndarray, cands: np.ndarray) -> np.ndarray:
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(cands).max(initial=0)) * queries.shape[1]
    if bound < 2.0**53:
        return (queries.astype(np.float64) @ cands.T.astype(np.float64)).astype(np.int64)
    return queries @ cands.T


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(query ids, candidate ids, scores, own, low, width) of each pair of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            qids, cids = np.frombuffer(row["q_ids"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int64)
            scores = _scores(_matrix(row["dim"], len(qids), row["q_vecs"]), _matrix(row["dim"], len(cids), row["vecs"]))
            low, width = (np.frombuffer(row[c], dtype=np.int64) for c in ("low", "width"))
            yield qids, cids, scores, qids[:, None] == cids[None, :], low, width


def _ranges(batches):
    for qids, _, scores, own, _, _ in _blocks(batches):
        big = np.iinfo(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids), pa.array(np.where(own, big.max, scores).min(axis=1)), pa.array(np.where(own, big.min, scores).max(axis=1)),
             pa.array((~own).sum(axis=1))], names=["query_id", "low", "high", "n"])


def _histograms(batches):
    for qids, _, scores, own, low, width in _blocks(batches):
        bins = (scores - low[:, None]) // np.maximum(width, 1)[:, None]
        fit = ~own & (bins >= 0) & (bins < BINS) & (width > 0)[:, None]
        q, _ = np.nonzero(fit)
        counts = np.bincount(q * BINS + bins[fit], minlength=len(qids) * BINS)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids[hit // BINS]), pa.array((hit % BINS).astype(np.int64)), pa.array(counts[hit].astype(np.int64))],
            names=["query_id", "bin", "n"])


def _above(k: int):
    def run(batches):
        for qids, cids, scores, own, kth, _ in _blocks(batches):
            over = ~own & (scores > kth[:, None])
            q, c = np.nonzero(over)
            parts = [(qids[q], cids[c], scores[q, c])]
            tie = ~own & (scores == kth[:, None])
            for q in np.flatnonzero(tie.any(axis=1)):
                least = np.sort(cids[tie[q]])[:k]
                parts.append((np.full(len(least), qids[q]), least, np.full(len(least), kth[q])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([p[i] for p in parts])) for i in range(3)], names=["query_id", "vec_id", "score"])

    return run


def _pass(blocks: DataFrame, queries: DataFrame, state: DataFrame | None, fn, schema: str) -> DataFrame:
    """``fn`` over every pair of a candidate block and a query block of its dimension.

    Blocks are dealt to SALTS groups and query blocks to all of them, so a pair's key is never hot.
    """
    if state is None:
        ranged = queries.withColumns({"low": F.lit(b""), "width": F.lit(b"")})
    else:
        ranged = queries.join(state, ["dim", "q_block"])
    ranged = ranged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = blocks.withColumn("salt", F.pmod(F.hash("block"), F.lit(SALTS))).withColumn("q_block", F.explode("q_blocks"))
    return dealt.drop("q_blocks").join(ranged, ["dim", "q_block", "salt"]).mapInArrow(fn, schema)


def _packed_state(members: DataFrame, state: DataFrame) -> DataFrame:
    """Range of every query, laid out in the order of its block."""
    kind = "dim int, q_block long, low binary, width binary"

    def lay(batches):
        for batch in batches:
            for r in batch.to_pylist():
                order = np.argsort(np.array([x["at"] for x in r["rows"]]))
                pick = lambda c: np.array([x[c] for x in r["rows"]], dtype=np.int64)[order].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["dim"]], pa.int32()), pa.array([r["q_block"]], pa.int64()), pa.array([pick("low")], pa.binary()),
                     pa.array([pick("width")], pa.binary())], names=["dim", "q_block", "low", "width"])

    rows = members.join(state, "query_id", "left").select(
        "dim", "q_block", F.struct("at", F.coalesce("low", F.lit(0)).alias("low"), F.coalesce("width", F.lit(0)).alias("width")).alias("r"))
    return rows.groupBy("dim", "q_block").agg(F.collect_list("r").alias("rows")).mapInArrow(lay, kind)


def _members(batches):
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["q_ids"], dtype=np.int64)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["dim"]] * n, pa.int32()), pa.array([r["q_block"]] * n, pa.int64()), pa.array(np.arange(n)), pa.array(ids)],
                names=["dim", "q_block", "at", "query_id"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` (vec_id, v) for every row of ``queries``."""
    asked = packed(queries, QUERY_BLOCK).select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
    asked = freeze(asked, "queries")
    met = asked.groupBy("dim").agg(F.collect_list("q_block").alias("q_blocks"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = freeze(packed(vectors, BLOCK).join(met, "dim").repartition(parts, "dim", "block"), "blocks")
    members = freeze(asked.mapInArrow(_members, "dim int, q_block long, at long, query_id long"), "members")
    spread = _pass(blocks, asked, None, _ranges, "query_id long, low long, high long, n long")
    spread = spread.groupBy("query_id").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).filter("n > 0")
    # need: which score of the range is the k-th of all, counted from above
    # Widths are powers of BINS, so the bins of a pass fill one bin of the pass before exactly.
    span = F.col("high") - F.col("low") + 1
    width = F.lit(BINS**6)
    for power in reversed(range(6)):
        width = F.when(span <= BINS ** (power + 1), F.lit(BINS**power)).otherwise(width)
    state = freeze(spread.select("query_id", "low", width.cast("long").alias("width"), F.least("n", F.lit(k)).alias("need")), "ranges")
    while state.agg(F.max("width")).first()[0]:
        counts = _pass(blocks, asked, _packed_state(members, state), _histograms, "query_id long, bin long, n long")
        counts = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        upto = counts.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        at = upto.join(state, "query_id").filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        refined = at.select(
            "query_id", (F.col("low") + F.col("bin") * F.col("width")).alias("low"), F.expr(f"width div {BINS}").alias("width"),
            (F.col("need") - (F.col("upto") - F.col("n"))).alias("need"))
        state = freeze(refined.unionByName(state.filter("width = 0")), "ranges")
    found = _pass(blocks, asked, _packed_state(members, state), _above(k), "query_id long, vec_id long, score long")
    found = found.join(state.select("query_id"), "query_id", "left_semi")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
