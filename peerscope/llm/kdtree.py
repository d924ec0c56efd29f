"""Exact top-k search by inner product on KD-trees, one tree per shard.

A shard is a block of vectors of whole numbers, split at the median of its widest dimension down to leaves of at most
``LEAF`` rows; every node has the tight bounding box of its rows.  The largest product a box allows, the sum over
dimensions of max(q*low, q*high), bounds all rows below a node.  Each query goes through a tree best-first and stops
when the best bound left is below its k-th score, which goes on from shard to shard of a task.  Where doubles can't hold
the products exactly, bounds are rounded outwards and leaves are scored in Python integers.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from peerscope.llm.blocks import BLOCK_ROWS, best_of_tiles, merge, pack
from peerscope.llm.shared import table

K = 5
EVERY = 50
LEAF = 256
SCALE = 256
EXACT = float(1 << 53)
OUTWARDS = 1e-9  # of the sum of the products' sizes: far above the rounding of doubles
LONG = (1 << 63) - 1


def tree(ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> dict | None:
    """A shard's payload: ids and points in tree order; of each node its box, rows and children (0: a leaf)."""
    if not len(ids):
        return None
    points = np.floor(SCALE * rows)
    order = np.arange(len(ids))
    nodes, low, high = [], [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        part = points[order[start:end]]
        lo, hi = part.min(axis=0), part.max(axis=0)
        me = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = me
        nodes.append([start, end, 0, 0])
        low.append(lo)
        high.append(hi)
        widest = int((hi - lo).argmax())
        if end - start > leaf and hi[widest] > lo[widest]:
            half = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(part[:, widest], half)]
            todo += [(start, start + half, me, 0), (start + half, end, me, 1)]
    return {"ids": ids[order], "points": points[order], "_nodes": np.array(nodes), "_low": np.array(low), "_high": np.array(high)}


def search_tree(asked: dict, c: dict, best: list, k: int = K) -> None:
    """All queries of a block through one shard's tree."""
    q, points, ids, nodes = asked["points"], c["points"], c["ids"], c["_nodes"].tolist()
    exact = np.abs(q).max() * np.abs(points).max() * q.shape[1] < EXACT
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = np.maximum(q, 0) @ c["_high"].T + np.minimum(q, 0) @ c["_low"].T
        if not exact:
            bounds += OUTWARDS * (np.abs(q) @ np.maximum(np.abs(c["_high"]), np.abs(c["_low"])).T)
            bounds[~np.isfinite(bounds)] = np.inf
    for i, own in enumerate(asked["own"].tolist()):
        scores, found = best[i]
        kth = scores[k - 1] if len(scores) == k else -np.inf
        bound = bounds[i].tolist()
        queue = [(-bound[0], 0)]
        while queue and -queue[0][0] >= kth:  # an equal bound may hide a smaller id
            start, end, left, right = nodes[heapq.heappop(queue)[1]]
            if left:
                heapq.heappush(queue, (-bound[left], left))
                heapq.heappush(queue, (-bound[right], right))
                continue
            product = (points[start:end] @ q[i]).astype(np.int64) if exact else _held(points[start:end], q[i])
            at = np.flatnonzero((product >= kth) & (np.arange(start, end) != own))
            if len(at):
                scores, found = merge((scores, found), product[at], ids[start:end][at], k)
                kth = scores[k - 1] if len(scores) == k else -np.inf
        best[i] = scores, found


def _held(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Products in whole numbers of any size, held to 64 bits."""
    q = [int(x) for x in query]
    return np.array([max(-LONG, min(LONG, sum(a * int(b) for a, b in zip(q, row, strict=True)))) for row in points], dtype=np.int64)


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY, vec_id: str = "vec_id",
                 embedding: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of floor(256 * x) for rows with id divisible by ``every``.

    Rows with a null id, and vectors that are null, empty or hold a null or non-finite component, take no part;
    vectors meet only vectors of their own dimension.  A query's own row is no candidate, but another row with the
    same id is.  Equal scores go to the smaller vec_id; scores beyond 64 bits are held at the largest ones.
    """
    blocks = pack(vectors, tree, "kdtree-shards", vec_id, embedding, block_rows)
    return best_of_tiles(blocks, every, k, lambda q, c, best: search_tree(q, c, best, k), "long")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS p FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.p, c.p), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
) WHERE rank <= 5
"""
