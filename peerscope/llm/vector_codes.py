"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Vectors of whole numbers are cut into ``PARTS`` equal consecutive parts, each with a codebook of ``ENTRIES`` entries that
starts as that part of the vectors with the smallest ids and is refined in ``ROUNDS`` rounds.  For every entry of a
codebook the others are listed by their distance from it.  A part starts at some entry and goes down that entry's list;
a nearer entry found there is jumped to, and its list is gone down next; entries seen before are marked and skipped.
The list is left where its distances exceed twice the part's distance from the current entry: by the triangle
inequality nothing beyond can be nearer.  All parts of a batch take their steps together.

A round is one pass over the vectors: each task sums up the parts of each entry, and only these sums, as many numbers as
the codebooks have, meet.  Codebooks are broadcast; ``MOST_NUMBERS`` bounds their size.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from peerscope.llm.shared import stage, table
from peerscope.operators.joins import salted_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LANES = 64
MOST_NUMBERS = 1 << 24  # whole numbers in all codebooks together
NARROW = 1 << 24  # components below this have products and sums of thousands of squares within 64 bits
LONG = (1 << 63) - 1

Codebooks = dict[int, list[np.ndarray]]  # dimension: of each part the entries as rows


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    """floor(256 * x) of doubles; Python integers where 64 bits might not do for what follows."""
    if not rows.size or np.abs(rows).max() < NARROW / SCALE:
        return np.floor(SCALE * rows).astype(np.int64)
    exact = [[math.floor(SCALE * x) if abs(x) < 1 << 53 else SCALE * int(x) for x in row] for row in rows.tolist()]
    out = np.empty(rows.shape, dtype=object)
    out[:] = exact
    return out


def _narrowed(numbers: np.ndarray) -> np.ndarray:
    """64-bit numbers where they do, else as they are."""
    return numbers.astype(np.int64) if not numbers.size or np.abs(numbers).max() < NARROW else numbers


def vectors_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, vectors as doubles) of each dimension."""
    length = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for dim in np.unique(length):
        at = np.flatnonzero(length == dim)
        values = pc.list_flatten(column.take(pa.array(at))).to_numpy(zero_copy_only=False).astype(np.float64)
        yield at, values.reshape(len(at), int(dim))


def cut(points: np.ndarray, parts: int) -> np.ndarray:
    """(vector, part, component) of vectors, behind which as many zeros come as equal parts need."""
    n, dim = points.shape
    width = -(-dim // parts)
    wide = np.zeros((n, width * parts), dtype=points.dtype)
    wide[:, :dim] = points
    return wide.reshape(n, parts, width)


def neighbour_lists(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry the squared distances to all entries, and these sorted by distance, the smaller index first."""
    distance = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    return distance, np.argsort(distance, axis=1, kind="stable")


def orchard(points: np.ndarray, entries: np.ndarray, lists: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each point, ties to the lower index."""
    between, order = lists or neighbour_lists(entries)
    n, m = len(points), len(entries)
    everyone = np.arange(n)
    at = _starts(points, entries)
    distance = ((points - entries[at]) ** 2).sum(axis=1)
    seen = np.zeros((n, m), dtype=bool)
    seen[everyone, at] = True
    step = np.zeros(n, dtype=np.int64)
    going = everyone
    while len(going):
        here = at[going]
        other = order[here, step[going]]
        near = between[here, other] <= 4 * distance[going]  # twice the distance, squared
        going, here, other = going[near], here[near], other[near]
        new = ~seen[going, other]
        seen[going, other] = True
        step[going] += 1
        fresh, entry = going[new], other[new]
        found = ((points[fresh] - entries[entry]) ** 2).sum(axis=1)
        better = (found < distance[fresh]) | ((found == distance[fresh]) & (entry < at[fresh]))
        jump = fresh[better]
        at[jump], distance[jump], step[jump] = entry[better], found[better], 0
        going = going[step[going] < m]
    return at, distance


def _starts(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """An entry that is near in the component in which the entries differ most."""
    if not entries.shape[1]:
        return np.zeros(len(points), dtype=np.int64)
    widest = int(np.argmax(entries.max(axis=0) - entries.min(axis=0)))
    order = np.argsort(entries[:, widest], kind="stable")
    at = np.searchsorted(entries[order, widest], points[:, widest])
    return order[np.minimum(at, len(entries) - 1)].astype(np.int64)


class _Search:
    """Codebooks with their neighbour lists, made once a task."""

    def __init__(self, codebooks: Codebooks) -> None:
        self.books = {dim: [(e, neighbour_lists(e)) for e in parts] for dim, parts in codebooks.items()}

    def codes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(parts, nearest entries, squared distances) of vectors of one dimension."""
        books = self.books[points.shape[1]]
        parts = cut(points, len(books))
        found = [orchard(parts[:, p], e, lists) for p, (e, lists) in enumerate(books)]
        return parts, np.stack([a for a, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def first_entries(vectors: DataFrame, vec_id: str, embedding: str, entries: int, parts: int) -> Codebooks:
    """The codebooks to start from: of each dimension the vectors with the smallest ids, null ids last."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("v")).withColumn("dim", F.size("v"))
    order = (F.col("id").asc_nulls_last(), F.col("v"))
    for by in (("dim", F.pmod(F.xxhash64("id", "v"), F.lit(LANES))), ("dim",)):  # in two levels
        rows = rows.withColumn("nth", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("nth") <= entries)
    dims = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    numbers = dims.agg(F.sum(F.col("n") * F.col("dim")).alias("numbers")).first().numbers or 0
    if numbers > MOST_NUMBERS:
        raise ValueError(f"codebooks of {numbers} numbers are more than {MOST_NUMBERS}: too many dimensions for one table")
    of_dim: dict[int, list] = {}
    for r in rows.orderBy("dim", "nth").collect():  # at most MOST_NUMBERS numbers
        of_dim.setdefault(r.dim, []).append(r.v)
    out = {}
    for dim, found in of_dim.items():
        whole = cut(whole_numbers(np.array(found, dtype=np.float64).reshape(len(found), dim)), parts)
        out[dim] = [whole[:, p] for p in range(parts)]
    return out


def refined(vectors: DataFrame, embedding: str, codebooks: Codebooks) -> Codebooks:
    """One round: every entry becomes the floor of the mean of the parts nearest to it; unused entries stay."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(shared.value)
        total = {dim: [(np.zeros(e.shape, dtype=object), np.zeros(len(e), dtype=np.int64)) for e in parts] for dim, parts in shared.value.items()}
        for batch in batches:
            for _, rows in vectors_of(batch.column(0)):
                parts, nearest, _ = search.codes(whole_numbers(rows))
                for p, (sum_, count) in enumerate(total[rows.shape[1]]):
                    here = np.zeros(sum_.shape, dtype=parts.dtype)
                    np.add.at(here, nearest[:, p], parts[:, p])
                    sum_ += here
                    count += np.bincount(nearest[:, p], minlength=len(count))
        out = [(dim, p, e, int(count[e]), pickle.dumps(sum_[e].tolist()))
               for dim, parts in total.items() for p, (sum_, count) in enumerate(parts) for e in np.flatnonzero(count).tolist()]
        if out:
            kinds = {"dim": pa.int32(), "part": pa.int32(), "entry": pa.int32(), "n": pa.int64(), "total": pa.binary()}
            yield pa.record_batch({c: pa.array(x, kinds[c]) for c, x in zip(kinds, zip(*out, strict=True), strict=True)})

    def met(group: pa.Table) -> pa.Table:
        n = sum(group["n"].to_pylist())
        total = [sum(x) for x in zip(*map(pickle.loads, group["total"].to_pylist()), strict=True)]
        return pa.table({c: group[c].slice(0, 1) for c in ("dim", "part", "entry")} | {"mean": pa.array([pickle.dumps([x // n for x in total])], pa.binary())})

    of_task = vectors.select(embedding).mapInArrow(sums, "dim int, part int, entry int, n long, total binary")
    means = of_task.groupBy("dim", "part", "entry").applyInArrow(met, "dim int, part int, entry int, mean binary").collect()
    shared.destroy()
    out = {dim: [e.astype(object) for e in parts] for dim, parts in codebooks.items()}
    for r in means:
        out[r.dim][r.part][r.entry] = pickle.loads(r.mean)
    return {dim: [_narrowed(e) for e in parts] for dim, parts in out.items()}


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id",
                  embedding: str = "embedding") -> Codebooks:
    """The codebooks of the usable vectors, for each dimension of its own."""
    kept = vectors.filter(usable(F.col(embedding)))
    books = first_entries(kept, vec_id, embedding, entries, parts)
    for _ in range(rounds):
        books = refined(kept.withColumn(embedding, F.col(embedding).cast("array<double>")), embedding, books)
    return books


def codebook_digest(parts: list[np.ndarray]) -> str:
    """Lowercase SHA-256 of all entries' decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for entries in parts for x in entries.ravel().tolist()).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, codebooks: Codebooks, vec_id: str = "vec_id", embedding: str = "embedding",
                   label: str = "label") -> DataFrame:
    """vec_id, label, codes (array of int, one a part) and error (squared distances summed) of every usable vector."""
    kept = vectors.filter(usable(F.col(embedding))).select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(codebooks)
        for batch in batches:
            for at, rows in vectors_of(batch["v"]):
                _, nearest, distance = search.codes(whole_numbers(rows))
                take = pa.array(at)
                error = [min(int(x), LONG) for x in distance.sum(axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(take), batch["label"].take(take), pa.array([rows.shape[1]] * len(at), pa.int32()),
                     pa.array(nearest.tolist(), pa.list_(pa.int32())), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "dim", "codes", "error"])

    kinds = [kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return kept.mapInArrow(codes, f"vec_id {kinds[0]}, label {kinds[1]}, dim int, codes array<int>, error long")


def decode_vectors(encoded: DataFrame, codebooks: Codebooks) -> DataFrame:
    """vec_id and approximate vector (array of double) of coded rows: the entries' components, scaled back."""
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, codes in zip(batch["dim"].to_pylist(), batch["codes"].to_pylist(), strict=True):
                books = codebooks[dim]
                out.append([float(x) / SCALE for e, c in zip(books, codes, strict=True) for x in e[c].tolist()][:dim])
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "vector"])

    return encoded.select("vec_id", "dim", "codes").mapInArrow(
        decoded, f"vec_id {encoded.schema['vec_id'].dataType.simpleString()}, vector array<double>")


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id",
                     embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every usable vector; other columns are not read.

    Vectors that are null or hold a null or non-finite component are dropped.  Vectors of different dimensions have
    codebooks of their own, a dimension that cannot be cut evenly is filled up with zeros, and an empty vector has
    code 00 in every part.  Null ids come last where the first entries are chosen; of rows with one id the smaller vector
    comes first.  Repeated rows are coded alike, each for itself; rows with a null label are one group.  Fewer vectors
    than ``entries`` give smaller codebooks, an empty table an empty result.  Errors beyond 64 bits are held there.
    """
    vectors = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    books = fit_codebooks(vectors, parts, entries, rounds, "vec_id", "embedding")
    coded = stage(encode_vectors(vectors, books, "vec_id", "embedding", "label"), "vector-codes")
    digest = F.lit(None).cast("string")
    for dim, found in books.items():
        digest = F.when(F.col("dim") == dim, F.lit(codebook_digest(found))).otherwise(digest)
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = coded.select("vec_id", "label", code.alias("code"), "error", digest.alias("codebooks_sha256"), F.struct("label").alias("same"))
    total = rows.groupBy("same").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias("label_error"))
    return salted_join(rows, total, "same", "vec_id").select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, error, error of the label and digest of the codebooks of every usable embedding."""
    return compress_vectors(table(spark, sf_dir, "embeddings")).drop("label")


def _sql() -> str:
    """The same in SQL: parts as rows, nearest entries by comparing all, rounds one after another."""
    def nearest(name: str, book: str) -> str:
        return f"""{name} AS (
  SELECT vec_id, part, p, d // 64 AS distance, (d % 64)::BIGINT AS entry FROM (
    SELECT x.vec_id, x.part, any_value(x.p) AS p,
           min(list_sum(list_transform(list_zip(x.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * 64 + b.entry) AS d
    FROM x JOIN {book} b ON b.part = x.part GROUP BY x.vec_id, x.part))"""

    def renewed(name: str, codes: str, book: str) -> str:
        return f"""{name} AS (
  SELECT b.part, b.entry, coalesce(m.p, b.p) AS p FROM {book} b LEFT JOIN (
    SELECT part, entry, list(c ORDER BY place) AS p FROM (
      SELECT part, entry, place, floor_div(sum(v), count(*)) AS c FROM (
        SELECT part, entry, unnest(p) AS v, generate_subscripts(p, 1) AS place FROM {codes})
      GROUP BY part, entry, place) GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry)"""

    steps = [nearest("c0", "b0"), renewed("b1", "c0", "b0"), nearest("c1", "b1"), renewed("b2", "c1", "b1"), nearest("c2", "b2")]
    query = """
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS p FROM whole, range(16) r(part)
), b0 AS MATERIALIZED (
  SELECT x.part, f.entry, x.p FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole ORDER BY vec_id LIMIT 64) f ON f.vec_id = x.vec_id
), STEPS, e AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error FROM c2 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2
)
SELECT whole.vec_id, e.code, e.error, (sum(e.error) OVER (PARTITION BY whole.label))::BIGINT AS label_error, digest.codebooks_sha256
FROM whole JOIN e ON e.vec_id = whole.vec_id, digest
"""
    floor_div = "((sum(v) - (((sum(v) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT"
    return query.replace("STEPS", ", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)).replace("floor_div(sum(v), count(*))", floor_div)


SQL = _sql()
