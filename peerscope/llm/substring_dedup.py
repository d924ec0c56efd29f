"""Substring dedup: repeated runs of ``WIDTH`` words, found by fixed-block anchors.

Every text is cut into non-overlapping blocks of ``BLOCK`` words, and every rolling run of ``BLOCK`` words probes the
blocks.  ``2 * BLOCK - 1 <= WIDTH``, so any window of ``WIDTH`` words holds a whole block of its own text; if the
window occurs elsewhere, a rolling probe there has that block's words.  A hit block is then extended both ways: the
windows around it are compared on 96-bit hashes, and the overlapping windows that do occur elsewhere merge into
maximal exact repeats, whose words are removed.

Texts are dealt into groups of about ``GROUP_BYTES``.  A group reduces what it sends: each hash once, 4 bytes a probe
without its place, packed into one binary a bucket of hashes.  So a run that a third of all texts share is one
entry a group, nothing is paired, and what comes back to a group are only its own blocks and windows that repeat.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from peerscope.llm.shared import byte_texts, hidden, stage, table, window_hashes, word_hashes

WIDTH = 35
GROUP_BYTES = 4_000_000
BUCKET_BYTES = 12_000_000


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash, so that sorted hashes lie bucket by bucket."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _low(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _once(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of equally long columns, ascending, and how often each occurs."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0])
    sorted_ = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in sorted_], axis=0)
    at = np.flatnonzero(new)
    return [c[at] for c in sorted_], np.diff(np.append(at, len(order)))


def _slices(h: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """(bucket, slice) of the non-empty buckets of sorted hashes."""
    if not len(h):
        return []
    of = _bucket(h, buckets)
    cuts = np.flatnonzero(np.diff(of, prepend=np.uint64(buckets) + np.uint64(1)))
    return [(int(of[a]), slice(int(a), int(b))) for a, b in zip(cuts, np.append(cuts[1:], len(h)), strict=True)]


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in column.to_pylist()]


class _Group:
    """The words of a group's texts, and its anchors."""

    def __init__(self, texts: list[bytes], width: int) -> None:
        self.width, self.block = width, (width + 1) // 2
        self.words, self.first = word_hashes(texts)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.place = np.arange(len(self.words)) - self.first[self.text]

    def inside(self, width: int) -> np.ndarray:
        """Whether the run of ``width`` words from each word on stays in its text."""
        n = max(0, len(self.words) - width + 1)
        return self.text[:n] == self.text[width - 1: width - 1 + n]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct probes and their counts; first word and hash of each block."""
        runs, inside = window_hashes(self.words, self.block, 3), self.inside(self.block)
        (probes,), counts = _once(runs[inside])
        blocks = np.flatnonzero(inside & (self.place[: len(inside)] % self.block == 0))
        return probes, counts, blocks, runs[blocks]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes (64 and 32 bits) of the windows from each word on, and whether each stays in its text."""
        return (window_hashes(self.words, self.width, 5), _low(window_hashes(self.words, self.width, 6)), self.inside(self.width))


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, group_bytes: int = GROUP_BYTES,
                   settled: bool = False) -> DataFrame:
    """``docs`` with n_words, n_removed and kept (the words left, joined by a space); hidden names on a clash.

    A word goes if a window of ``width`` consecutive words that covers it starts anywhere else too, in the same text,
    another one or a repeated row.  Null and empty texts have no words (kept is empty).  Texts shorter than a window
    keep all; very long ones are taken whole.  Ids are not looked at; other columns pass through; an empty table gives
    an empty result.

    The rows are read several times and must fall into the same groups each time, so they are staged first.  Pass
    ``settled`` for a frame that reads files, whose rows come in the same parts each time anyway.
    """
    docs = docs if settled else stage(docs, "repeat-texts")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    g = hidden("group", docs.columns)
    # rows that are alike in all columns are told apart by the part of the input they are read from
    same = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    grouped = docs.withColumn(g, F.pmod(F.xxhash64(*same, F.spark_partition_id()), F.lit(groups)))

    columns, out = docs.columns, StructType(list(docs.schema.fields))  # add() changes a schema in place
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept", "string")):
        out = out.add(hidden(name, out.fieldNames()), kind)
    names = out.fieldNames()

    def ask(t: pa.Table) -> pa.Table:
        mine = _Group(byte_texts(t[text]), width)
        probes, counts, _, blocks = mine.anchors()
        blocks = np.intersect1d(blocks, probes[counts == 1], assume_unique=False)  # the others are known to repeat
        rows = {"bucket": [], "probes": [], "blocks": []}
        cut = dict(_slices(blocks, buckets))
        for b, s in _slices(probes, buckets):
            rows["bucket"].append(b)
            rows["probes"].append(_low(probes[s]).tobytes())
            rows["blocks"].append(_low(blocks[cut[b]]).tobytes() if b in cut else b"")
        return pa.table({"bucket": pa.array(rows["bucket"], pa.int64()), "origin": pa.array([t[g][0].as_py()] * len(rows["bucket"]), pa.int64()),
                         "probes": pa.array(rows["probes"], pa.binary()), "blocks": pa.array(rows["blocks"], pa.binary())})

    def hit(t: pa.Table) -> pa.Table:
        every = np.sort(np.concatenate(_arrays(t["probes"], np.uint32)))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        rows = [(o, b[np.isin(b, shared, assume_unique=True)]) for o, b in zip(t["origin"].to_pylist(), _arrays(t["blocks"], np.uint32), strict=True)]
        rows = [(o, b) for o, b in rows if len(b)]
        return pa.table({g: pa.array([o for o, _ in rows], pa.int64()), "bucket": pa.array([t["bucket"][0].as_py()] * len(rows), pa.int64()),
                         "blocks": pa.array([b.tobytes() for _, b in rows], pa.binary())})

    def extend(t: pa.Table, replies: pa.Table) -> pa.Table:
        mine = _Group(byte_texts(t[text]), width)
        probes, counts, at, blocks = mine.anchors()
        told = [np.uint64(b) << np.uint64(32) | x.astype(np.uint64)
                for b, x in zip(replies["bucket"].to_pylist(), _arrays(replies["blocks"], np.uint32), strict=True)]
        told = np.concatenate(told) if told else np.zeros(0, dtype=np.uint64)
        own = _bucket(blocks, buckets) << np.uint64(32) | _low(blocks).astype(np.uint64)
        anchored = np.zeros(len(mine.words) + mine.block, dtype=bool)
        anchored[at] = np.isin(own, told) | np.isin(blocks, probes[counts > 1])
        a, b, inside = mine.windows()
        start = np.flatnonzero(inside)
        start = start[anchored[start + (-mine.place[start]) % mine.block]]
        (a, b), counts = _once(a[start], b[start])
        cut = _slices(a, buckets)
        return pa.table({
            "bucket": pa.array([k for k, _ in cut], pa.int64()), "origin": pa.array([t[g][0].as_py()] * len(cut), pa.int64()),
            "a": pa.array([a[s].tobytes() for _, s in cut], pa.binary()), "b": pa.array([b[s].tobytes() for _, s in cut], pa.binary()),
            "known": pa.array([np.packbits(counts[s] > 1).tobytes() for _, s in cut], pa.binary())})

    def confirm(t: pa.Table) -> pa.Table:
        a, b = _arrays(t["a"], np.uint64), _arrays(t["b"], np.uint32)
        known = [np.unpackbits(k, count=len(x)).astype(bool) for k, x in zip(_arrays(t["known"], np.uint8), a, strict=True)]
        origin = np.repeat(np.arange(len(a)), [len(x) for x in a])
        a, b, known = np.concatenate(a), np.concatenate(b), np.concatenate(known)
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        repeated = known[order]
        repeated[1:] |= same
        repeated[:-1] |= same
        pick = order[repeated]
        rows = []
        ids = t["origin"].to_pylist()
        for k in np.unique(origin[pick]):
            x = pick[origin[pick] == k]
            rows.append((ids[k], a[x].tobytes(), b[x].tobytes()))
        return pa.table({g: pa.array([r[0] for r in rows], pa.int64()), "a": pa.array([r[1] for r in rows], pa.binary()),
                         "b": pa.array([r[2] for r in rows], pa.binary())})

    def remove(t: pa.Table, replies: pa.Table) -> pa.Table:
        texts = byte_texts(t[text])
        mine = _Group(texts, width)
        gone = np.zeros(len(mine.words) + 1, dtype=np.int32)
        if replies.num_rows:
            ra, rb = np.concatenate(_arrays(replies["a"], np.uint64)), np.concatenate(_arrays(replies["b"], np.uint32))
            order = np.argsort(ra)
            ra, rb = ra[order], rb[order]
            a, b, inside = mine.windows()
            found = np.minimum(np.searchsorted(ra, a), len(ra) - 1)
            start = np.flatnonzero(inside & (ra[found] == a) & (rb[found] == b))
            gone[start] += 1
            np.add.at(gone, start + width, -1)
        covered = np.cumsum(gone[:-1]) > 0
        removed = np.add.reduceat(np.append(covered, False), mine.first[:-1], dtype=np.int64) * (np.diff(mine.first) > 0) if len(texts) else np.zeros(0)
        kept = []
        for i, raw in enumerate(texts):
            words = raw.split()
            kept.append(b" ".join(compress(words, ~covered[mine.first[i]: mine.first[i + 1]]) if removed[i] else words))
        return pa.table([*(t[c] for c in columns), pa.array(np.diff(mine.first), pa.int64()), pa.array(removed.astype(np.int64), pa.int64()),
                         pa.array(kept, pa.binary()).cast(pa.string())], names=names)

    asked = grouped.groupBy(g).applyInArrow(ask, "bucket long, origin long, probes binary, blocks binary")
    hits = asked.groupBy("bucket").applyInArrow(hit, f"`{g}` long, bucket long, blocks binary")
    windows = grouped.groupBy(g).cogroup(hits.groupBy(g)).applyInArrow(extend, "bucket long, origin long, a binary, b binary, known binary")
    repeats = windows.groupBy("bucket").applyInArrow(confirm, f"`{g}` long, a binary, b binary")
    return grouped.groupBy(g).cogroup(repeats.groupBy(g)).applyInArrow(remove, out)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, settled=True).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT r, s, array_to_string(words[s : s + 34], ' ') AS run FROM texts, range(1, greatest(1, len(words) - 33)) t(s)
), repeated AS (
  SELECT r, s FROM windows WHERE run IN (SELECT run FROM windows GROUP BY run HAVING count(*) > 1)
), covered AS (
  SELECT r, list(DISTINCT p) AS places FROM (SELECT r, unnest(range(s, s + 35)) AS p FROM repeated) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM texts LEFT JOIN covered USING (r)
"""
