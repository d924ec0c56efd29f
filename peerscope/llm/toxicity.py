"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word's embedding is the sum of two of ``BUCKETS`` hashed ones, its own and its stem's (the first ``STEM`` letters),
so an unseen form of a seen word is not unknown.  Filters one, two and three words wide slide over the whole text, each
keeps its largest value (max pooling), and a logistic layer turns these into a score.  An embedding's first number
starts at the smoothed log odds of its bucket in the training texts, the rest at small noise; everything is then
trained by Adagrad.  The gradient only reaches the word a filter kept, so an update touches few embeddings.

All labelled rows outside the held-out fold take part.  They are dealt by the hash of their words into shards of about
``SHARD_ROWS`` texts; the log odds are counted over all shards, each shard trains the network from that common start, and
the networks are averaged, an embedding over the shards that moved it.  The model's size is fixed, so it is broadcast.
One labelled text in ``CALIBRATE`` of every shard is kept from training; all of these calibrate the thresholds of the languages.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from peerscope.llm.shared import at_end, hidden, stage, table

BUCKETS = 1 << 19
SIZE = 8  # numbers an embedding
FILTERS = 8  # filters of each width
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
STEM = 4
KNOWN_WORDS = 250_000  # words a task remembers
SHARD_ROWS = 8_000  # different labelled texts that one task trains on
BROADCAST_IDS = 1_000_000  # labelled ids, up to which they go to every executor
SHARD_BYTES = 8 << 20  # of their text, UTF-8
PIECE = 200_000  # words of a training batch looked at together, if it is longer
EPOCHS = 3
BATCH = 32
RATE = 0.05
WORD_RATE = 0.01  # slower: a rare word must not answer for one odd label
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
CALIBRATE = 5  # one labelled row in so many calibrates the thresholds
STEPS = np.round(np.arange(0.05, 1.0, 0.05), 2)  # thresholds tried
MAX_PARTS = 4096
LEAST_OF_A_KIND = 5  # toxic and clean rows a language needs for a threshold of its own

_WORD = re.compile(r"\w+")


def words_of(text: str | None, known: dict[str, tuple[int, int]]) -> np.ndarray:
    """(bucket of the word, bucket of its stem) of the words of a whole text, in order."""
    found = _WORD.findall((text or "").lower())
    if len(known) > KNOWN_WORDS:
        known.clear()
    out = []
    for w in found:
        at = known.get(w)
        if at is None:
            raw, stem = w.encode("utf-8", "surrogatepass"), w[:STEM].encode("utf-8", "surrogatepass")
            at = known[w] = zlib.crc32(raw) % BUCKETS, zlib.crc32(b"^" + stem) % BUCKETS
        out.append(at)
    return np.array(out, dtype=np.int32).reshape(-1, 2)


class Classifier:
    """The network; bucket ``BUCKETS`` is the empty word behind every text, and stays zero."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.seed = seed
        self.words = self._untrained(rng)
        self.filters = [rng.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, 0, 0] = 1.0 / len(f)
        self.shift = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.top = rng.normal(0, 0.1, (len(WIDTHS), FILTERS)).astype(np.float32)
        self.top[:, 0] = 0.5
        self.bias = np.float32(-2.0)
        self.trained = False

    @staticmethod
    def _untrained(rng: np.random.Generator) -> np.ndarray:
        words = np.zeros((BUCKETS + 1, SIZE), dtype=np.float32)
        words[:-1, 1:] = rng.normal(0, 0.01, (BUCKETS, SIZE - 1))
        return words

    def __getstate__(self) -> dict:
        """The trained embeddings alone; the others are their noise, which the seed gives again."""
        start = self._untrained(np.random.default_rng(self.seed))
        touched = np.flatnonzero((np.abs(self.words - start) > 1e-12).any(axis=1))
        return {k: v for k, v in vars(self).items() if k != "words"} | {"touched": touched, "rows": self.words[touched]}

    def __setstate__(self, state: dict) -> None:
        touched, rows = state.pop("touched"), state.pop("rows")
        vars(self).update(state)
        self.words = self._untrained(np.random.default_rng(self.seed))
        self.words[touched] = rows

    def _laid_out(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All texts in one row, each followed by ``PAD`` empty words (an empty text is one more), and their starts."""
        pad = np.full((PAD, 2), BUCKETS, dtype=np.int32)
        one = pad[:1]
        parts = [p for t in texts for p in ((t if len(t) else one), pad)]
        lens = np.array([max(1, len(t)) + PAD for t in texts])
        return np.concatenate(parts), np.cumsum(lens) - lens

    def _maps(self, row: np.ndarray) -> list[np.ndarray]:
        """What each filter of each width gives at each word."""
        x, n = self.words[row[:, 0]] + self.words[row[:, 1]], len(row) - PAD
        taps = x @ np.concatenate([tap for f in self.filters for tap in f], axis=1)
        out, at = [], 0
        for f, s in zip(self.filters, self.shift, strict=True):
            m = taps[:n, at: at + FILTERS] + s
            for j in range(1, len(f)):
                m += taps[j: j + n, at + j * FILTERS: at + (j + 1) * FILTERS]
            out.append(m)
            at += len(f) * FILTERS
        return out

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Probability of label 1 of each text; texts are taken some ten thousand words at a time."""
        if not self.trained:
            return np.zeros(len(texts))
        out, block, size = [], [], 0
        for i, t in enumerate(texts):
            block.append(t)
            size += len(t)
            if size > 50_000 or i == len(texts) - 1:
                row, starts = self._laid_out(block)
                logit = np.full(len(block), self.bias, dtype=np.float64)
                ends = np.append(starts[1:], len(row)) - PAD
                for width, m in enumerate(self._maps(row)):
                    for e in ends[:-1]:
                        m[e: e + PAD] = -np.inf  # starts inside the padding
                    logit += np.maximum(np.maximum.reduceat(m, starts), 0) @ self.top[width]
                out.append(1 / (1 + np.exp(-logit)))
                block, size = [], 0
        return np.concatenate(out) if out else np.zeros(0)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> "Classifier":
        if not len(texts) or labels.min() == labels.max():
            return self  # nothing to tell apart: scores stay 0
        seen = np.zeros((2, BUCKETS))
        for t, y in zip(texts, labels, strict=True):
            seen[int(y), np.unique(t)] += 1
        self.begin(log_odds(seen, [int((labels == 0).sum()), int((labels == 1).sum())]))
        self.learn(texts, labels, epochs, seed)
        return self

    def begin(self, odds: np.ndarray) -> "Classifier":
        """The start of training, from the ``log_odds`` of the training texts."""
        self.words[:-1, 0] = odds
        self.trained = True
        return self

    def dense(self) -> np.ndarray:
        """All parameters but the embeddings, in one row."""
        return np.concatenate([x.ravel() for x in (*self.filters, *self.shift, self.top, np.array([self.bias], dtype=np.float32))])

    def set_dense(self, row: np.ndarray) -> None:
        for x in (*self.filters, *self.shift, self.top):
            x[...] = row[:x.size].reshape(x.shape)
            row = row[x.size:]
        self.bias = np.float32(row[0])

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> dict:
        """Adagrad over the texts in random order; gives its sums of squares."""
        rng = np.random.default_rng(seed)
        grown = {"words": np.full_like(self.words, 0.1), "filters": [np.full_like(f, 0.1) for f in self.filters],
                 "shift": [np.full_like(s, 0.1) for s in self.shift], "top": np.full_like(self.top, 0.1), "bias": 0.1}
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                at = order[i: i + BATCH]
                self._step([texts[j] for j in at], labels[at], grown)
        return grown

    def _peaks(self, row: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each width, where each filter is largest in each text, and what it gives there; a long row in pieces."""
        if len(row) <= PIECE:
            maps = self._maps(row)
            kept = [np.array([s + m[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)]) for m in maps]
            return kept, [np.take_along_axis(m, at, axis=0) for m, at in zip(maps, kept, strict=True)]
        kept = [np.repeat(starts[:, None], FILTERS, axis=1) for _ in WIDTHS]
        value = [np.full((len(starts), FILTERS), -np.inf, dtype=np.float32) for _ in WIDTHS]
        for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            for p in range(s, e, PIECE):
                for k, m in enumerate(self._maps(row[p: min(e, p + PIECE) + PAD])):
                    at = m.argmax(axis=0)
                    best = m[at, np.arange(FILTERS)]
                    kept[k][i] = np.where(best > value[k][i], p + at, kept[k][i])
                    value[k][i] = np.maximum(best, value[k][i])
        return kept, value

    def _step(self, texts: list[np.ndarray], labels: np.ndarray, grown: dict) -> None:
        row, starts = self._laid_out(texts)
        ends = np.append(starts[1:], len(row)) - PAD
        kept, value = self._peaks(row, starts, ends)
        pooled = [np.maximum(v, 0) for v in value]
        logit = sum((p @ t for p, t in zip(pooled, self.top, strict=True)), np.full(len(texts), self.bias))
        wrong = ((1 / (1 + np.exp(-logit))) - labels).astype(np.float32) / len(texts)
        rows, pushes = [], []
        for k, f in enumerate(self.filters):
            back = wrong[:, None] * self.top[k] * (value[k] > 0)
            new = np.empty_like(f)
            for j in range(len(f)):
                word = row[kept[k] + j]  # text x filter x (word, stem)
                new[j] = np.einsum("tf,tfs->sf", back, self.words[word].sum(axis=2))
                rows.append(word.reshape(-1, 2))
                pushes.append((back[:, :, None] * f[j].T[None]).reshape(-1, SIZE))
            grown["top"][k] += (g := wrong @ pooled[k]) ** 2
            self.top[k] -= RATE * g / np.sqrt(grown["top"][k])
            grown["shift"][k] += (g := back.sum(axis=0)) ** 2
            self.shift[k] -= RATE * g / np.sqrt(grown["shift"][k])
            grown["filters"][k] += new ** 2
            f -= RATE * new / np.sqrt(grown["filters"][k])
        grown["bias"] += (g := float(wrong.sum())) ** 2
        self.bias -= np.float32(RATE * g / np.sqrt(grown["bias"]))
        touched, which = np.unique(np.concatenate(rows), return_inverse=True)
        push = np.zeros((len(touched), SIZE), dtype=np.float32)
        for side in which.reshape(-1, 2).T:
            np.add.at(push, side, np.concatenate(pushes))
        push[touched == BUCKETS] = 0
        grown["words"][touched] += push ** 2
        self.words[touched] -= WORD_RATE * push / np.sqrt(grown["words"][touched])


def log_odds(seen: np.ndarray, n: list[int]) -> np.ndarray:
    """Half the smoothed log odds of each bucket; ``seen``: the clean and the toxic texts that hold it, ``n``: all of them."""
    odds = np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 1) / (n[0] + 2))
    return (odds - np.log((n[0] + 2) / (n[1] + 2))) / 2  # an unseen bucket is 0


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled ids outside the held-out fold; of several labels the toxic one counts."""
    return labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) != HELD_OUT)) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _of_labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) != HELD_OUT)).join(known, "doc_id")


def _words_of_rows(rows: DataFrame) -> DataFrame:
    """(nth, toxic, lang, words); of equal words only those rows of a task that come before all earlier ones.

    So a large group of copies is dealt as a few rows, and its first row is always among them.
    """
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, int]] = {}
        best: dict[bytes, tuple] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                b, at, found = whole.slice(start, 1000), [], []
                for i, (nth, toxic, lang, text) in enumerate(zip(*(b[c].to_pylist() for c in ("nth", "toxic", "lang", "text")), strict=True)):
                    w, rank = words_of(text, cache), (nth, toxic, lang is not None, lang)
                    if (key := hashlib.blake2b(w.tobytes(), digest_size=16).digest()) not in best or rank < best[key]:
                        best[key] = rank
                        at.append(i)
                        found.append(w.ravel())
                part = b.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([part["nth"], part["toxic"], part["lang"], pa.array(found, pa.list_(pa.int32()))],
                                                 names=["nth", "toxic", "lang", "words"])

    return rows.select(F.xxhash64("doc_id").alias("nth"), "toxic", F.col("lang").cast("string").alias("lang"), "text") \
        .mapInArrow(words, "nth long, toxic int, lang string, words array<int>")


def training_rows(docs: DataFrame, labels: DataFrame, limit: int | None = None, limit_bytes: int | None = None) -> DataFrame:
    """(nth, toxic, lang, words) of all labelled rows outside the held-out fold, or of some of them.

    With ``limit`` at most so many rows, those with the smallest hashes of their ids.  With ``limit_bytes`` too, ids are
    taken until the next one's texts would exceed that, and an id whose own rows have over a sixteenth of it is left out.
    """
    known = _labelled(labels)
    if limit is not None:
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    if limit is not None and limit_bytes is not None:
        sizes = docs.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.sum(F.octet_length("text")).alias("bytes"))
        until = W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, 0)  # at most ``limit`` ids
        known = sizes.withColumn("bytes", F.coalesce("bytes", F.lit(0))).filter(F.col("bytes") * 16 <= limit_bytes) \
            .withColumn("total", F.sum("bytes").over(until)).filter(F.col("total") <= limit_bytes).select("doc_id", "toxic")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, int]] = {}
        for b in batches:
            rows = [words_of(t, cache).ravel() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["nth"], b["toxic"], b["lang"], pa.array(rows, pa.list_(pa.int32()))],
                                             names=["nth", "toxic", "lang", "words"])

    rows = _of_labelled(docs, known).select(F.xxhash64("doc_id").alias("nth"), "toxic", F.col("lang").cast("string").alias("lang"), "text") \
        .mapInArrow(words, "nth long, toxic int, lang string, words array<int>")
    return rows if limit is None else rows.orderBy("nth", F.xxhash64("words")).limit(limit)


def _arrays(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Each row of a list column as an array."""
    return [np.asarray(x, dtype=np.int32) for c in getattr(column, "chunks", [column]) for x in c.to_numpy(zero_copy_only=False)]


SHARD = "shard int, place int, toxic int, lang string, kept boolean, words array<int>"


def _shard(rows: pa.Table) -> pa.Table:
    """The different texts of a shard, by the hashes of their ids; ``kept``: one in ``CALIBRATE``, kept from training."""
    words = _arrays(rows["words"])
    nth, toxic, lang = (rows[c].to_pylist() for c in ("nth", "toxic", "lang"))
    order = sorted(range(len(words)), key=lambda i: (nth[i], zlib.crc32(words[i].tobytes()), toxic[i], lang[i] is not None, lang[i] or ""))
    seen, first = set(), []
    for i in order:  # copies count once
        if (raw := hashlib.blake2b(words[i].tobytes(), digest_size=16).digest()) not in seen:
            seen.add(raw)
            first.append(i)
    found, place = rows.select(["shard", "toxic", "lang", "words"]).take(pa.array(first)), np.arange(len(first), dtype=np.int32)
    return pa.table({"shard": found["shard"], "place": pa.array(place), "toxic": found["toxic"], "lang": found["lang"],
                     "kept": pa.array(place % CALIBRATE == 0), "words": found["words"]})


def _texts_of(rows: pa.Table | pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """The texts and labels of a shard's rows, in their order."""
    return [w.reshape(-1, 2) for w in _arrays(rows["words"])], rows["toxic"].to_numpy().astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, clean, toxic): the texts that hold each bucket; bucket -1 counts all."""
    seen, n = np.zeros((2, BUCKETS), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for b in batches:
        for t, y in zip(*_texts_of(b), strict=True):
            seen[y, np.unique(t)] += 1
            n[y] += 1
    at = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), *(pa.array(np.append(seen[y, at], n[y])) for y in (0, 1))],
                                     names=["bucket", "clean", "toxic"])


def _started(counts: pa.Table) -> pa.Table:
    """One row: the log odds of all buckets; none, if the texts are all of one kind."""
    bucket, both = counts["bucket"].to_numpy(), np.array([counts[c].to_numpy() for c in ("clean", "toxic")])
    n = both[:, bucket == -1].sum(axis=1)
    seen = np.zeros((2, BUCKETS))
    seen[:, bucket[bucket >= 0]] = both[:, bucket >= 0]
    return pa.table({"odds": pa.array([log_odds(seen, n.tolist()).astype(np.float32).tobytes()] if n.all() else [], pa.binary())})


def _averaged(group: pa.Table) -> pa.Table:
    """(bucket, value): the mean of the shards' values by their weights, always summed in the order of the shards."""
    group = group.sort_by([("bucket", "ascending"), ("shard", "ascending")])
    bucket, weight = group["bucket"].to_numpy(), group["weight"].to_numpy()
    out = []
    for dense in (True, False):
        if not len(at := np.flatnonzero((bucket == -1) == dense)):
            continue
        value = np.array([np.frombuffer(group["value"][i].as_py(), dtype=np.float32) for i in at.tolist()], dtype=np.float64)
        starts = np.flatnonzero(np.diff(bucket[at], prepend=-2))
        mean = np.add.reduceat(value * weight[at, None], starts) / np.add.reduceat(weight[at], starts)[:, None]
        out += [(int(b), x.tobytes()) for b, x in zip(bucket[at][starts], mean.astype(np.float32), strict=True)]
    return pa.table({"bucket": pa.array([b for b, _ in out], pa.int32()), "value": pa.array([x for _, x in out], pa.binary())})


def _shards(docs: DataFrame, labels: DataFrame, limit: int | None) -> tuple[DataFrame, int]:
    """Staged rows of all shards, and the number of these."""
    known = stage(_labelled(labels), "toxicity-ids")
    if known.count() <= BROADCAST_IDS:
        known = F.broadcast(known)
    texts = _of_labelled(docs.select("doc_id", F.xxhash64("text").alias("body"), F.octet_length("text").alias("bytes")), known)
    size = texts.groupBy("body").agg(F.max("bytes").alias("bytes")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    n = max(1, -(-size.n // SHARD_ROWS), -(-size.bytes // SHARD_BYTES))
    rows = _words_of_rows(_of_labelled(docs, known)) if limit is None else training_rows(docs, labels, limit)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(n)).cast("int")).repartition(min(n, MAX_PARTS), "shard")
    return stage(dealt.groupBy("shard").applyInArrow(_shard, SHARD), "toxicity-shards"), n


def train(docs: DataFrame, labels: DataFrame, limit: int | None = None) -> tuple[Classifier, dict[str, float]]:
    """The classifier, and the threshold of each language that has enough rows kept from training.

    All labelled rows are used, unless ``limit`` is given.  What reaches the driver are the log odds and the model, both
    of fixed size, and the thresholds.
    """
    spark = docs.sparkSession
    shards, n = _shards(docs, labels, limit)
    counts = shards.filter("NOT kept").mapInArrow(_counted, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    start = counts.groupBy(F.lit(0).alias("all")).applyInArrow(_started, "odds binary").collect()
    if not start:
        return Classifier(), _thresholds(shards, Classifier())
    odds = spark.sparkContext.broadcast(start[0].odds)  # of fixed size
    at_end(odds.destroy)

    def begun() -> Classifier:
        return Classifier().begin(np.frombuffer(odds.value, dtype=np.float32))

    def trained(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        before, model = begun().words, begun()
        grown = model.learn(*_texts_of(rows))
        moved = np.flatnonzero((model.words != before).any(axis=1))
        weight = np.maximum((grown["words"][moved].astype(np.float64) - 0.1).sum(axis=1), 1e-9)
        values = [model.dense().tobytes(), *(x.tobytes() for x in model.words[moved])]
        return pa.table({"bucket": pa.array(np.insert(moved, 0, -1).astype(np.int32)),
                         "shard": pa.array(np.full(len(values), rows["shard"][0].as_py(), dtype=np.int32)),
                         "weight": pa.array(np.insert(weight, 0, rows.num_rows)), "value": pa.array(values, pa.binary())})

    def assembled(rows: pa.Table) -> pa.Table:
        model = begun()
        for bucket, value in zip(rows["bucket"].to_pylist(), rows["value"].to_pylist(), strict=True):
            if bucket < 0:
                model.set_dense(np.frombuffer(value, dtype=np.float32))
            else:
                model.words[bucket] = np.frombuffer(value, dtype=np.float32)
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    moved = shards.filter("NOT kept").repartition(min(n, MAX_PARTS), "shard").groupBy("shard") \
        .applyInArrow(trained, "bucket int, shard int, weight double, value binary")
    mean = moved.groupBy(F.pmod("bucket", F.lit(max(64, n)))).applyInArrow(_averaged, "bucket int, value binary")
    model = pickle.loads(mean.groupBy(F.lit(0).alias("all")).applyInArrow(assembled, "model binary").first().model)  # of fixed size
    return model, _thresholds(shards, model)


def _thresholds(shards: DataFrame, model: Classifier) -> dict[str, float]:
    """The thresholds calibrated on all texts kept from training."""
    shared = shards.sparkSession.sparkContext.broadcast(model)  # of fixed size
    at_end(shared.destroy)

    def passed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        texts, toxic = _texts_of(rows)
        steps = np.searchsorted(STEPS, shared.value.score(texts), side="right")
        return pa.table({"lang": rows["lang"], "toxic": pa.array(toxic, pa.int32()), "passed": pa.array(steps, pa.int32())})

    rows = shards.filter("kept AND lang IS NOT NULL").groupBy("shard").applyInArrow(passed, "lang string, toxic int, passed int") \
        .groupBy("lang", "toxic", "passed").agg(F.count(F.lit(1)).alias("n"))
    return {r.lang: r.threshold for r in rows.groupBy("lang").applyInArrow(calibrated, "lang string, threshold double").orderBy("lang").collect()}


def calibrated(counts: pa.Table) -> pa.Table:
    """For one language the threshold with the best F1; of equally good ones the nearest to ``THRESHOLD``.

    ``counts``: how many texts of each label reach just so many of ``STEPS``.  No row, if there are too few of a label.
    """
    exact = np.zeros((2, len(STEPS) + 1), dtype=np.int64)
    np.add.at(exact, (counts["toxic"].to_numpy(), counts["passed"].to_numpy()), counts["n"].to_numpy())
    reach = exact[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]  # texts that reach each step
    out = []
    if exact.sum(axis=1).min() >= LEAST_OF_A_KIND:
        f1 = 2 * reach[1] / (reach.sum(axis=0) + exact[1].sum())
        best = STEPS[f1 >= f1.max() - 1e-12]
        out.append(float(best[np.abs(best - THRESHOLD).argmin()]))
    return pa.table({"lang": counts["lang"].slice(0, len(out)), "threshold": pa.array(out, pa.float64())})


def score_documents(docs: DataFrame, labels: DataFrame, limit: int | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``rejected`` (score at or over its language's threshold); hidden on a clash.

    Scores read the text alone, very long ones whole.  Null and empty texts score like a text of no words.  Rows with a null id or language
    are scored too (the common threshold stands in for an unknown language); repeated rows score alike.  Labels with a
    null id or label are left out, of several labels of one id the toxic one counts.  Without labels of both kinds
    every score is 0 and nothing is rejected.
    """
    spark = docs.sparkSession
    named = docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(None).cast("string"))
    model, thresholds = train(named, labels, limit)
    shared = spark.sparkContext.broadcast(model)  # of fixed size
    at_end(shared.destroy)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, tuple[int, int]] = {}
        for part in texts:
            yield pd.Series(shared.value.score([words_of(t, cache) for t in part]))

    out = {c: hidden(c, docs.columns) for c in ("score", "rejected")}
    limit_of = F.lit(THRESHOLD)
    for name, t in thresholds.items():
        limit_of = F.when(F.col("lang") == name, F.lit(t)).otherwise(limit_of)
    scored = named.withColumn(out["score"], score("text"))
    return scored.select(*docs.columns, out["score"], (F.col(out["score"]) >= limit_of).alias(out["rejected"]))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, and whether its language's threshold rejects it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = score_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", (_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "rejected")
