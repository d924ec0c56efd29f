"""A stated query set against all vectors, in blocks: packing, pairing of blocks, merging of each query's best rows.

Vectors are packed where they are read, up to ``BLOCK_ROWS`` of one dimension a block, and staged.  Query rows come
from the same blocks, so a row knows itself by (block, place).  Query blocks and blocks meet in a grid of tasks: a query
block goes to every column of its row, a block to every row of its column, so both are copied about sqrt(tasks) times
at most, whatever their number and that of the shuffle partitions.  A task holds one block pair (tile) at a time and
takes its queries in strips.  Per query only its k best rows of a tile leave the task.
"""

from __future__ import annotations

import math
import pickle
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from peerscope.llm.shared import stage

BLOCK_ROWS = 8192
OPEN_QUERY_BLOCKS = 64
STRIP = 256  # queries of a tile at a time

Build = Callable[[np.ndarray, np.ndarray], dict | None]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows as float64) of each dimension in the batch; null ids, null vectors and empty ones are left out."""
    ids, vectors = batch.column(0), batch.column(1)
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    length = np.where(ids.is_valid().to_numpy(zero_copy_only=False), length, 0)
    for dim in np.unique(length[length > 0]):
        at = pa.array(np.flatnonzero(length == dim))
        values = pc.list_flatten(vectors.take(at)).to_numpy(zero_copy_only=False).astype(np.float64)
        rows = values.reshape(-1, int(dim))
        good = np.isfinite(rows).all(axis=1)
        yield ids.take(at).to_numpy(zero_copy_only=False).astype(np.int64)[good], rows[good]


def pack(vectors: DataFrame, build: Build, name: str, vec_id: str, embedding: str, block_rows: int) -> DataFrame:
    """Staged blocks (block, dim, payload): ``build(ids, rows)`` makes a block's payload, a dict of arrays with ``ids``."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dim: int, everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block
            ids = np.concatenate([i for i, _ in held[dim]])
            rows = np.concatenate([r for _, r in held[dim]])
            while len(ids) >= block_rows or everything and len(ids):
                payload = build(ids[:block_rows], rows[:block_rows])
                ids, rows = ids[block_rows:], rows[block_rows:]
                if payload is not None:
                    yield pa.record_batch({"block": pa.array([block], pa.int64()), "dim": pa.array([dim], pa.int32()),
                                           "payload": pa.array([pickle.dumps(payload)], pa.binary())})
                    block += 1
            held[dim] = [(ids, rows)]

        for batch in batches:
            for ids, rows in _matrices(batch):
                dim = rows.shape[1]
                held.setdefault(dim, []).append((ids, rows))
                if sum(len(i) for i, _ in held[dim]) >= block_rows:
                    yield from flush(dim, False)
        for dim in list(held):
            yield from flush(dim, True)

    rows = vectors.select(F.col(vec_id).cast("long"), F.col(embedding).cast("array<double>"))
    return stage(rows.mapInArrow(packed, "block long, dim int, payload binary"), name)


def grid(query_blocks: int, blocks: int, tasks: int) -> tuple[int, int]:
    """(rows, columns) of a grid of at most about ``tasks`` cells that copies as few blocks as possible."""
    columns = min(max(1, blocks), tasks, max(1, round(math.sqrt(tasks * max(1, blocks) / max(1, query_blocks)))))
    return min(max(1, query_blocks), max(1, tasks // columns)), columns


def best_of_tiles(blocks: DataFrame, every: int, k: int,
                  search: Callable[[dict, dict, list], None], score_type: str, tasks: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best candidates over all tiles, ties to the smaller vec_id.

    ``search(queries, candidates, best)`` updates ``best``, a (scores, ids) pair for each query, with one tile; what
    earlier tiles of the same task found is in it, so a bound goes on from tile to tile.
    """
    spark = blocks.sparkSession
    n = blocks.count()
    rows, columns = grid(n, n, tasks or 2 * spark.sparkContext.defaultParallelism)

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, dim, raw in zip(*(batch[c].to_pylist() for c in ("block", "dim", "payload")), strict=True):
                payload = pickle.loads(raw)
                at = np.flatnonzero(payload["ids"] % every == 0)
                if len(at):
                    own = {"at": at} | {c: x[at] for c, x in payload.items() if len(x) == len(payload["ids"]) and not c.startswith("_")}
                    yield pa.record_batch({"from": pa.array([block], pa.int64()), "dim": pa.array([dim], pa.int32()),
                                           "queries": pa.array([pickle.dumps(own)], pa.binary())})

    long = score_type == "long"

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: OrderedDict[int, tuple[dict, list]] = OrderedDict()

        def done(block: int) -> pa.RecordBatch:
            asked, best = open_blocks.pop(block)
            n = [len(ids) for _, ids in best]
            return pa.record_batch({
                "row": pa.array(np.repeat((block << 16) + asked["at"], n), pa.int64()),
                "query_id": pa.array(np.repeat(asked["ids"], n), pa.int64()),
                "vec_id": pa.array(np.concatenate([ids for _, ids in best]), pa.int64()),
                "score": pa.array(np.concatenate([s for s, _ in best]), pa.int64() if long else pa.float64())})

        for batch in batches:
            for i in range(batch.num_rows):
                block, origin = batch["block"][i].as_py(), batch["from"][i].as_py()
                candidates = pickle.loads(batch["payload"][i].as_py())
                if origin not in open_blocks:
                    asked = pickle.loads(batch["queries"][i].as_py())
                    none = np.zeros(0, dtype=np.int64 if long else np.float64), np.zeros(0, dtype=np.int64)
                    open_blocks[origin] = asked, [none] * len(asked["at"])
                open_blocks.move_to_end(origin)
                asked, best = open_blocks[origin]
                whole = asked | {"own": asked["at"] if origin == block else np.full(len(asked["at"]), -1)}
                for start in range(0, len(best), STRIP):
                    part = slice(start, start + STRIP)
                    some = best[part]
                    search({c: x[part] for c, x in whole.items()}, candidates, some)
                    best[part] = some
                if len(open_blocks) > OPEN_QUERY_BLOCKS:
                    yield done(next(iter(open_blocks)))
        for origin in list(open_blocks):
            yield done(origin)

    across = F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda j: F.pmod(F.xxhash64("from"), F.lit(rows)) * columns + j)
    down = F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: i * columns + F.pmod(F.xxhash64("block"), F.lit(columns)))
    asked = blocks.mapInArrow(queries, "`from` long, dim int, queries binary").withColumn("cell", F.explode(across))
    found = asked.join(blocks.withColumn("cell", F.explode(down)), ["cell", "dim"]).select("from", "queries", "block", "payload") \
        .mapInArrow(tiles, f"row long, query_id long, vec_id long, score {score_type}")
    order = W.partitionBy("row", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def merge(best: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both: highest score first, then smallest id."""
    if len(scores) > 4 * k:  # all that tie with the k-th stay in the running
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= kth
        scores, ids = scores[keep], ids[keep]
    scores, ids = np.concatenate((best[0], scores)), np.concatenate((best[1], ids))
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]
