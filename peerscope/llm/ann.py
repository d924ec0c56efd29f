"""Approximate nearest neighbours by a block matrix join: int8 product tiles with error bounds, then floats.

Each vector is scaled to length 1 and stored as int8 with one scale; the length of what rounding took away is kept.
An int8 product of a tile then gives every cosine with a proven bound; a pair survives if its upper bound reaches
the k-th best lower bound of its query (earlier tiles included).  Survivors are recomputed in double precision on
the original vectors, and each query's best rows are merged.  As the bounds hold, recall is 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from peerscope.llm.blocks import BLOCK_ROWS, best_of_tiles, merge, pack
from peerscope.llm.shared import table

K = 5
EVERY = 50
SLACK = 1e-9  # far above rounding of the double precision sums
PAIRS_AT_ONCE = 1 << 16


def quantised(ids: np.ndarray, rows: np.ndarray) -> dict | None:
    """A block's payload: ids, the rows, their lengths, int8 directions, scales, lengths of these and of the error."""
    largest = np.abs(rows).max(axis=1)
    some = largest > 0
    ids, rows, largest = ids[some], rows[some], largest[some]
    if not len(ids):
        return None
    norm = np.sqrt(((rows / largest[:, None]) ** 2).sum(axis=1)) * largest
    unit = rows / norm[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    rounded = code * scale[:, None]
    return {"ids": ids, "rows": rows, "norm": norm, "code": code, "scale": scale,
            "rounded": np.sqrt((rounded ** 2).sum(axis=1)), "error": np.sqrt(((unit - rounded) ** 2).sum(axis=1))}


def search_tile(asked: dict, c: dict, best: list, k: int = K) -> None:
    """One tile: int8 products, bounds, and exact cosines of the pairs that survive."""
    wide = np.float32 if c["code"].shape[1] <= 1024 else np.float64  # whole numbers below 2^24 are exact in float32
    products = asked["code"].astype(wide) @ c["code"].T.astype(wide)
    near = products * (asked["scale"][:, None] * c["scale"][None, :])
    bound = asked["rounded"][:, None] * c["error"][None, :] + asked["error"][:, None] + SLACK
    own = asked["own"]
    rows = np.flatnonzero(own >= 0)
    near[rows, own[rows]] = -np.inf
    low = near - bound
    size = low.shape[1]
    kth = np.partition(low, size - k, axis=1)[:, size - k] if size >= k else np.full(len(own), -np.inf)
    known = np.array([s[k - 1] - SLACK if len(s) == k else -np.inf for s, _ in best])
    survives = (near + bound >= np.maximum(kth, known)[:, None]) & (near > -np.inf)
    q, x = np.nonzero(survives)
    scores = np.empty(len(q))
    for i in range(0, len(q), PAIRS_AT_ONCE):
        part = slice(i, i + PAIRS_AT_ONCE)
        a, b = asked["rows"][q[part]] / asked["norm"][q[part]][:, None], c["rows"][x[part]] / c["norm"][x[part]][:, None]
        scores[part] = (a * b).sum(axis=1)
    first = np.searchsorted(q, np.arange(len(own) + 1))
    for i in range(len(own)):
        part = slice(first[i], first[i + 1])
        if first[i + 1] > first[i]:
            best[i] = merge(best[i], scores[part], c["ids"][x[part]], k)


def nearest_neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, vec_id: str = "vec_id",
                       embedding: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by cosine of each row whose id is divisible by ``every``.

    Rows with a null id, and vectors that are null, empty, zero or hold a null or non-finite component, take no part;
    vectors meet only vectors of their own dimension.  A query's own row is no candidate, but another row with the
    same id is; repeated query rows give their result once each.  Equal scores go to the smaller vec_id.
    """
    blocks = pack(vectors, quantised, "ann-blocks", vec_id, embedding, block_rows)
    return best_of_tiles(blocks, every, k, lambda q, c, best: search_tile(q, c, best, k), "double")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
