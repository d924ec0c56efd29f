"""Helpers shared by the operators: staged tables, hidden column names, vectorised word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from peerscope.session import checkpoint_dir
from peerscope.sources.publish import Folders

_AT_END: ContextVar[list[Callable[[], None]] | None] = ContextVar("at_end", default=None)


@contextmanager
def stages_dropped() -> Iterator[None]:
    """Deletes what operators stage and broadcast inside, on leaving, after an error too.

    What is made from their frames must be written by then (``stage(..., keep=True)`` or any other write).  Without
    this scope the tables stay until ``spark.checkpoint.dir`` is cleared.  Of nested scopes the inner one answers.
    """
    done: list[Callable[[], None]] = []
    token = _AT_END.set(done)
    try:
        yield
    finally:
        _AT_END.reset(token)
        for end in reversed(done):
            end()


def at_end(end: Callable[[], None]) -> None:
    """``end`` is called when the surrounding ``stages_dropped`` is left; without one, never."""
    if (done := _AT_END.get()) is not None:
        done.append(end)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage, survives lost executors.

    ``stages_dropped`` leaves it alone with ``keep``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/peerscope-llm/{name}-{uuid.uuid4().hex}"
    if not keep:
        at_end(lambda: Folders(spark).delete(path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hidden(name: str, columns: list[str]) -> str:
    """A column name that no column of ``columns`` has (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# --- words and their hashes -------------------------------------------------

_U = np.uint64
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + _U((seed * 0xD1342543DE82EF95 + _BASE) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base | 1, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text, a null as no bytes."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes other than 0x20 and 0x09-0x0D) of all texts, and each text's first word.

    The second array has one entry more than there are texts.  Works on about 2 MB of text at a time.
    """
    hashes, counts, block, size = [], [], [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= 2_000_000:
            h, n = _hash_block(block, lower)
            hashes.append(h)
            counts.append(n)
            block, size = [], 0
    h, n = _hash_block(block, lower)
    hashes.append(h)
    counts.append(n)
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.concatenate(counts), out=first[1:])
    return np.concatenate(hashes), first


def _hash_block(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    if not texts:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        buf = _LOWER[buf]
    space = _IS_SPACE[buf]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    lens = ends - starts
    offsets = np.cumsum(lens) - lens
    letters = buf[~space]
    at = np.arange(len(letters)) - np.repeat(offsets, lens)
    values = _BYTE[letters] * _powers(_BASE, int(lens.max()))[at]
    return mix(np.add.reduceat(values, offsets) ^ (lens.astype(np.uint64) << _U(48))), counts


def window_hashes(words: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of ``width`` words, by its first word (runs that cross texts included)."""
    if len(words) < width:
        return np.zeros(0, dtype=np.uint64)
    base = int(mix(np.array([seed], dtype=np.uint64), 11)[0]) | 1
    out, done, part, size = None, 0, mix(words, seed), 1
    while size <= width:
        if width & size:
            out = part if out is None else _joined(out, part, done, base)
            done += size
        if size * 2 <= width:
            part = _joined(part, part, size, base)
        size *= 2
    return mix(out[: len(words) - width + 1], seed)


def _joined(left: np.ndarray, right: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of ``size`` words followed by those of the next run."""
    n = min(len(left), len(right) - size)
    return left[:n] + right[size: size + n] * _U(pow(base, size, 1 << 64))
