"""Hard-negative mining with segment summaries.

Vectors of whole numbers are packed into blocks.  A block stores, for one, four and sixteen segments of every vector,
each segment's mean and deviation.  A product of two vectors is the sum over segments of length * mean * mean and of the
products of what is left around the means, which lies within length * deviation * deviation: this bounds a pair's score
from the summaries alone.  Pairs whose bounds cannot matter are left out segment level by segment level, and the pairs
that remain are scored exactly.

It is done twice.  First each anchor's best rows of its own label are found (the positives); a pair matters if its upper
bound reaches the anchor's k-th best score or lower bound.  Each positive's score then spans a window of scores, and
each window's best rows of other labels are found; a pair matters if its bounds meet a window above what that window
already holds.

Anchors are gathered into blocks of their own and dealt with the candidates' blocks over a grid of tasks: every anchor
block goes to each column of the grid, every candidate block to each row, so both are copied about
sqrt(tasks) times at most, however many blocks there are.  A task holds one pair of blocks and takes anchors in
strips of ``STRIP``; per anchor and window only the best rows of a task leave it.
"""

from __future__ import annotations

import math
import pickle
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from peerscope.llm.blocks import STRIP, grid
from peerscope.llm.shared import stage, table
from peerscope.llm.vector_codes import LONG, usable, vectors_of, whole_numbers

EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # a negative's score, in percent of the positive's
BLOCK_ROWS = 8192
ANCHOR_ROWS = 2048  # of an anchor block, about
LEVELS = (1, 4, 16)
SLACK = 1e-5  # of the product of two lengths: far above the rounding of the float summaries
EXACT = float(1 << 53)
OPEN_ANCHORS = 64
DENSE = 0.05  # share of a strip's pairs from which on they are scored by one matrix product


def summaries(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each level the segments' lengths, and of every vector its segments' means and deviations."""
    dim, values = points.shape[1], points.astype(np.float64)
    out = []
    for n in LEVELS:
        edges = np.unique(np.linspace(0, dim, min(n, dim) + 1).astype(np.int64))
        lengths = np.diff(edges)
        mean = np.add.reduceat(values, edges[:-1], axis=1) / lengths
        around = (values - np.repeat(mean, lengths, axis=1)) ** 2
        deviation = np.sqrt(np.add.reduceat(around, edges[:-1], axis=1) / lengths)
        out.append((lengths, mean.astype(np.float32), deviation.astype(np.float32)))
    return out


def block_of(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict:
    """A block: row numbers, ids, labels as (names, codes), whole numbers, lengths and summaries."""
    points = whole_numbers(vectors)
    with np.errstate(over="ignore", invalid="ignore"):
        names, codes = np.unique(labels, return_inverse=True)
        block = {"row": rows, "ids": ids, "names": names.tolist(), "label": codes.astype(np.int32), "points": points,
                 "length": np.sqrt((points.astype(np.float64) ** 2).sum(axis=1)), "levels": summaries(points)}
    if points.dtype != object and np.abs(points).max() < 1 << 15:
        block["points"] = points.astype(np.int16)
    return block


def part_of(block: dict, at: np.ndarray) -> dict:
    """Some rows of a block."""
    return block | {c: block[c][at] for c in ("row", "ids", "label", "points", "length")} \
        | {"levels": [(n, m[at], d[at]) for n, m, d in block["levels"]]}


def joined(blocks: list[dict]) -> dict:
    """Blocks of one dimension as one."""
    names = sorted({n for b in blocks for n in b["names"]})
    code = {n: i for i, n in enumerate(names)}
    out = {c: np.concatenate([b[c] for b in blocks]) for c in ("row", "ids", "points", "length")}
    out["label"] = np.concatenate([np.array([code[n] for n in b["names"]], dtype=np.int32)[b["label"]] for b in blocks])
    levels = [(parts[0][0], np.concatenate([m for _, m, _ in parts]), np.concatenate([d for _, _, d in parts]))
              for parts in zip(*(b["levels"] for b in blocks), strict=True)]
    return out | {"names": names, "levels": levels}


def survivors(anchors: dict, c: dict, allowed: np.ndarray, need: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (anchor, candidate) that matter: ``need(low, high)`` tells from the bounds of all pairs which do.

    ``allowed`` marks the pairs to look at.  Level by level, candidates that matter to no anchor are left out.
    """
    columns = np.flatnonzero(allowed.any(axis=0))
    keep = allowed[:, columns]
    slack = (SLACK * anchors["length"])[:, None]
    with np.errstate(over="ignore", invalid="ignore"):
        for (lengths, mean, deviation), (_, their_mean, their_deviation) in zip(anchors["levels"], c["levels"], strict=True):
            if not len(columns):
                break
            middle = (mean * lengths.astype(np.float32)) @ their_mean[columns].T
            around = (deviation * lengths.astype(np.float32)) @ their_deviation[columns].T + slack * c["length"][columns][None, :] + SLACK
            low = np.where(keep, middle - around, -np.inf)
            high = np.where(keep, middle + around, -np.inf)
            keep &= need(low, high) | np.isnan(middle + around)  # numbers too large to bound stay
            some = keep.any(axis=0)
            columns, keep = columns[some], keep[:, some]
    q, x = np.nonzero(keep)
    return q, columns[x]


def exact_scores(anchors: dict, c: dict, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of pairs, held to 64 bits."""
    if not len(q):
        return np.zeros(0, dtype=np.int64)
    a, b = anchors["points"], c["points"]
    if a.dtype == object or b.dtype == object or anchors["length"].max() * c["length"].max() >= EXACT:
        a, b = a.astype(object), b.astype(object)
        return np.array([max(-LONG, min(LONG, sum(y * z for y, z in zip(a[i], b[j], strict=True)))) for i, j in zip(q.tolist(), x.tolist(), strict=True)], dtype=np.int64)
    columns, at = np.unique(x, return_inverse=True)  # every partial sum is below the product of the lengths: exact
    if len(q) > DENSE * len(a) * len(columns):
        return (a.astype(np.float64) @ b[columns].astype(np.float64).T)[q, at].astype(np.int64)
    out = np.empty(len(q), dtype=np.int64)
    for i in range(0, len(q), 1 << 16):
        part = slice(i, i + (1 << 16))
        out[part] = (a[q[part]].astype(np.float64) * b[x[part]].astype(np.float64)).sum(axis=1).astype(np.int64)
    return out


Best = tuple[np.ndarray, np.ndarray]  # scores and ids, best first


def better(best: Best, scores: np.ndarray, ids: np.ndarray, k: int) -> Best:
    """The k best of both: highest score first, then smallest id."""
    scores, ids = np.concatenate((best[0], scores)), np.concatenate((best[1], ids))
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _codes_of(anchors: dict, c: dict) -> np.ndarray:
    """The candidates' labels in the anchors' numbers; -1: a label no anchor has."""
    known = {n: i for i, n in enumerate(anchors["names"])}
    return np.array([known.get(n, -1) for n in c["names"]], dtype=np.int32)[c["label"]]


def find_positives(anchors: dict, c: dict, best: list[list[Best]], k: int) -> None:
    """One tile: each anchor's best rows of its label; its own row is none."""
    allowed = anchors["label"][:, None] == _codes_of(anchors, c)[None, :]
    allowed &= anchors["row"][:, None] != c["row"][None, :]
    known = np.array([s[k - 1] if len(s) == k else -np.inf for (s, _), in best])

    def need(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        n = low.shape[1]
        kth = np.partition(low, n - k, axis=1)[:, n - k] if n >= k else np.full(len(low), -np.inf)
        return high >= np.maximum(np.where(np.isnan(kth), -np.inf, kth), known)[:, None]

    q, x = survivors(anchors, c, allowed, need)
    scores = exact_scores(anchors, c, q, x)
    first = np.searchsorted(q, np.arange(len(best) + 1))
    for i in np.flatnonzero(np.diff(first)).tolist():
        part = slice(first[i], first[i + 1])
        best[i][0] = better(best[i][0], scores[part], c["ids"][x[part]], k)


def windows(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def find_negatives(anchors: dict, c: dict, best: list[list[Best]], k: int) -> None:
    """One tile: the best rows of other labels in each window (``anchors["windows"]``) of each anchor."""
    allowed = anchors["label"][:, None] != _codes_of(anchors, c)[None, :]
    spans = anchors["windows"]
    least, most = np.full(len(spans), np.inf), np.full(len(spans), -np.inf)
    for i, (found, own) in enumerate(zip(best, spans, strict=True)):
        for (s, _), (lo, hi) in zip(found, own, strict=True):
            if lo <= hi:
                least[i] = min(least[i], max(lo, s[k - 1]) if len(s) == k else lo)
                most[i] = max(most[i], hi)
    q, x = survivors(anchors, c, allowed, lambda low, high: (high >= least[:, None]) & (low <= most[:, None]))
    scores = exact_scores(anchors, c, q, x)
    first = np.searchsorted(q, np.arange(len(best) + 1))
    for i in np.flatnonzero(np.diff(first)).tolist():
        s, ids = scores[first[i]: first[i + 1]], c["ids"][x[first[i]: first[i + 1]]]
        order = np.lexsort((ids, -s))
        s, ids = s[order], ids[order]
        for w, (lo, hi) in enumerate(spans[i]):
            start, stop = np.searchsorted(-s, [-hi, -lo + 1]) if lo <= hi else (0, 0)
            if stop > start:
                part = slice(start, min(stop, start + k))
                best[i][w] = better(best[i][w], s[part], ids[part], k)


# --- blocks and the grid ----------------------------------------------------------

def pack(vectors: DataFrame, block_rows: int) -> DataFrame:
    """Staged (block, dim, payload) of rows (row, id, label, v)."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple]] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal block
            rows, ids, labels, points = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            block += 1
            return pa.record_batch({"block": pa.array([block], pa.int64()), "dim": pa.array([dim], pa.int32()),
                                    "payload": pa.array([pickle.dumps(block_of(rows, ids, labels, points))], pa.binary())})

        for batch in batches:
            rows, ids = (batch[c].to_numpy(zero_copy_only=False) for c in ("row", "id"))
            labels = np.array(batch["label"].to_pylist(), dtype=object)
            for at, points in vectors_of(batch["v"]):
                dim = points.shape[1]
                for i in range(0, len(at) if dim else 0, block_rows):
                    part = at[i: i + block_rows]
                    have = held.setdefault(dim, [])
                    if have and sum(len(r) for r, *_ in have) + len(part) > block_rows:
                        yield out(dim)
                        have = held.setdefault(dim, [])
                    have.append((rows[part], ids[part], labels[part], points[i: i + block_rows]))
        for dim in list(held):
            yield out(dim)

    return stage(vectors.mapInArrow(packed, "block long, dim int, payload binary"), "negative-blocks")


def anchor_blocks(blocks: DataFrame, every: int, anchor_rows: int) -> DataFrame:
    """Staged (anchor_block, dim, anchors): the anchors of all blocks, gathered into blocks of about ``anchor_rows``."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, dim, raw in zip(*(batch[c].to_pylist() for c in ("block", "dim", "payload")), strict=True):
                payload = pickle.loads(raw)
                at = np.flatnonzero(payload["ids"] % every == 0)
                for i in range(0, len(at), anchor_rows):
                    part = part_of(payload, at[i: i + anchor_rows])
                    yield pa.record_batch({"block": pa.array([block], pa.int64()), "dim": pa.array([dim], pa.int32()),
                                           "n": pa.array([len(part["ids"])], pa.int64()), "nth": pa.array([i], pa.int64()),
                                           "anchors": pa.array([pickle.dumps(part)], pa.binary())})

    found = stage(blocks.mapInArrow(chosen, "block long, dim int, n long, nth long, anchors binary"), "negative-anchors")
    groups = max(1, math.ceil((found.agg(F.sum("n").alias("n")).first().n or 0) / anchor_rows))

    def gathered(group: pa.Table) -> pa.Table:
        group = group.sort_by([("block", "ascending"), ("nth", "ascending")])
        whole = joined([pickle.loads(raw) for raw in group["anchors"].to_pylist()])
        return pa.table({"anchor_block": group["anchor_block"].slice(0, 1), "dim": group["dim"].slice(0, 1),
                         "anchors": pa.array([pickle.dumps(whole)], pa.binary())})

    dealt = found.withColumn("anchor_block", F.pmod(F.xxhash64("block", "nth"), F.lit(groups)))
    return stage(dealt.groupBy("anchor_block", "dim").applyInArrow(gathered, "anchor_block long, dim int, anchors binary"), "anchor-blocks")


def tiles(anchors: DataFrame, blocks: DataFrame, k: int, find: Callable[[dict, dict, list, int], None]) -> DataFrame:
    """(row, anchor_id, window, id, score): the best rows that ``find`` gathers in each window of each anchor.

    ``anchors``: (anchor_block, dim, anchors, windows); without windows an anchor has one.
    """
    spark = blocks.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    rows, columns = grid(anchors.count(), blocks.count(), tasks)
    asked = anchors.withColumn("cell", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(columns - 1)), lambda j: F.pmod(F.xxhash64("anchor_block"), F.lit(rows)) * columns + j)))
    dealt = blocks.withColumn("cell", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: i * columns + F.pmod(F.xxhash64("block"), F.lit(columns)))))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[tuple[int, int], tuple[dict, list]] = OrderedDict()

        def done(key: tuple[int, int]) -> pa.RecordBatch:
            a, best = held.pop(key)
            n = [[len(s) for s, _ in found] for found in best]
            return pa.record_batch({
                "row": pa.array(np.repeat(a["row"], [sum(x) for x in n]), pa.int64()),
                "anchor_id": pa.array(np.repeat(a["ids"], [sum(x) for x in n]), pa.int64()),
                "window": pa.array([w for x in n for w, m in enumerate(x) for _ in range(m)], pa.int32()),
                "id": pa.array([i for found in best for _, ids in found for i in ids.tolist()], pa.int64()),
                "score": pa.array([i for found in best for s, _ in found for i in s.tolist()], pa.int64())})

        for batch in batches:
            for i in range(batch.num_rows):
                key = batch["anchor_block"][i].as_py(), batch["dim"][i].as_py()
                c = pickle.loads(batch["payload"][i].as_py())
                if key not in held:
                    a = pickle.loads(batch["anchors"][i].as_py())
                    spans = {s["row"]: s["spans"] for s in batch["windows"][i].as_py() or []}
                    a["windows"] = [[(x["lo"], x["hi"]) for x in spans.get(r, [])] for r in a["row"].tolist()]
                    nothing = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                    of = [max(1, len(w)) for w in a["windows"]]
                    held[key] = a, [[nothing] * n for n in of]
                held.move_to_end(key)
                a, best = held[key]
                for start in range(0, len(best), STRIP):
                    strip = np.arange(start, min(start + STRIP, len(best)))
                    own = part_of(a, strip) | {"windows": a["windows"][start: start + STRIP]}
                    here = best[start: start + STRIP]
                    find(own, c, here, k)
                    best[start: start + STRIP] = here
                if len(held) > OPEN_ANCHORS:
                    yield done(next(iter(held)))
        for key in list(held):
            yield done(key)

    together = asked.join(dealt, ["cell", "dim"]).select("anchor_block", "dim", "anchors", "windows", "payload")
    return together.mapInArrow(searched, "row long, anchor_id long, window int, id long, score long")


SPANS = "array<struct<row: long, spans: array<struct<lo: long, hi: long>>>>"


def mine(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", block_rows: int = BLOCK_ROWS,
         anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank of every triple.

    Anchors are the rows whose id is divisible by ``every``, their positives the ``positives`` other rows of their
    label with the highest inner product of floor(256 * x), their hard negatives of each positive the ``negatives`` best
    rows of other labels that score from ``low`` to ``high`` percent of it.  Equal scores go to the smaller id.  Rows with
    a null id or label, and vectors that are null, empty or hold a null or non-finite component, take no part; vectors
    meet only vectors of their own dimension.  Labels are compared as text.  An anchor's own row is none of its
    positives, but another row with the same id is; repeated anchors give their triples once each.  Scores beyond 64
    bits are held there.  An empty table gives an empty result; other columns are not read.
    """
    rows = vectors.filter(usable(F.col(embedding)) & F.col(vec_id).isNotNull() & F.col(label).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("v"))
    blocks = pack(rows, block_rows)
    anchors = anchor_blocks(blocks, every, anchor_rows)
    found = tiles(anchors.withColumn("windows", F.lit(None).cast(SPANS)), blocks, positives, lambda a, c, best, k: find_positives(a, c, best, k))
    of_anchor = W.partitionBy("row").orderBy(F.desc("score"), "id")
    chosen = stage(found.withColumn("nth", F.row_number().over(of_anchor)).filter(F.col("nth") <= positives)
                   .select("row", "anchor_id", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # each anchor's windows travel to its block, in the order of the positives
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, dim, raw in zip(*(batch[c].to_pylist() for c in ("anchor_block", "dim", "anchors")), strict=True):
                own = pickle.loads(raw)["row"]
                yield pa.record_batch({"anchor_block": pa.array([block] * len(own), pa.int64()), "dim": pa.array([dim] * len(own), pa.int32()),
                                       "row": pa.array(own, pa.int64())})

    hundred = F.lit(100).cast("decimal(38,0)")
    wide = F.col("positive_score").cast("decimal(38,0)")
    lo, hi = F.ceil(wide * low / hundred), F.floor(wide * high / hundred)
    span = F.struct("nth", lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    spans = chosen.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("s")) \
        .select("row", F.transform("s", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))).alias("spans"))
    of_block = anchors.mapInArrow(rows_of, "anchor_block long, dim int, row long").join(spans, "row") \
        .groupBy("anchor_block", "dim").agg(F.collect_list(F.struct("row", "spans")).cast(SPANS).alias("windows"))
    ready = anchors.join(of_block, ["anchor_block", "dim"])
    hard = tiles(ready, blocks, negatives, lambda a, c, best, k: find_negatives(a, c, best, k))
    of_window = W.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    best = hard.withColumn("rank", F.row_number().over(of_window)).filter(F.col("rank") <= negatives) \
        .select("row", (F.col("window") + 1).alias("nth"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(chosen, ["row", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("nth").alias("positive_rank"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose id is divisible by 100; every seventh id's label is the next one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))


SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS p
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.p, c.p), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)::INTEGER AS positive_rank
  FROM scored WHERE same QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score, p.positive_rank
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
