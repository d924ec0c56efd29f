"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of more than ``CHUNK`` characters is cut into chunks that overlap the next one.  Chunks are pre-tokenised in
parallel; where the pre-token boundaries of two neighbours coincide inside the overlap, both continue alike for
good (a match depends only on what follows its start), so the text is stitched there, and the stitched pieces are
encoded in parallel and put together in order.  Chunks whose overlap has no common boundary (one unbroken run of
letters, say) are joined into one piece, so the result is exact for any text.  Only boundaries after a character
other than white space count: there a piece's end cannot change how its last white space matches.

A shorter text goes the same way inside the task that reads it, without a shuffle: ``pieces`` cuts it into chunks of
``OVERLAP`` characters that overlap by a quarter, stitches them, and its pieces are encoded one by one.  The pieces of
a long text are cut once more like that where they are encoded.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from peerscope.llm.shared import table

CHUNK = 32_768
OVERLAP = 1_024
LOOKAHEAD = 4  # characters after a match that can decide its length


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _decimals(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def boundaries(text: str, pattern: str, start: int, stop: int, last: bool) -> list[int]:
    """Ends of pre-tokens of ``text`` in [start, stop) that follow a character other than white space.

    ``last``: the text goes no further, so matches at its end are whole.
    """
    import regex

    found, at = [], 0
    sure = len(text) if last else len(text) - LOOKAHEAD
    for token in regex.findall(pattern, text):
        if start <= at < stop and at <= sure and (at == 0 or not text[at - 1].isspace()):
            found.append(at)
        at += len(token)
        if at >= stop:
            break
    return found


def pieces(text: str, pattern: str, chunk: int, overlap: int) -> list[str]:
    """``text`` cut at pre-token boundaries where neighbouring chunks meet; behind a chunk that meets none, not cut."""
    cuts, tail = [0], set()
    for first in range(0, len(text), chunk):
        end = first + chunk + overlap
        found = boundaries(text[first:end], pattern, 0, chunk + overlap, first + chunk >= len(text))
        if first:
            met = next((first + b for b in found if b < overlap and b in tail), None)
            if met is None:
                break
            cuts.append(met)
        tail = {b - chunk for b in found if b >= chunk}
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def _cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, chunk, last, slice) of the long texts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"].to_pylist(), strict=True):
                n = -(-len(text) // chunk)
                for first in range(0, n, 64):
                    ks = range(first, min(n, first + 64))
                    yield pa.record_batch({
                        "row": pa.array([row.as_py()] * len(ks), pa.int64()),
                        "doc_id": pa.array([doc_id.as_py()] * len(ks), batch["doc_id"].type),
                        "chunk": pa.array(ks, pa.int32()), "last": [k == n - 1 for k in ks],
                        "slice": [text[k * chunk: (k + 1) * chunk + overlap] for k in ks]})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"row long, doc_id {id_type}, chunk int, last boolean, slice string")


def stitched_pieces(docs: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, piece, part): the texts cut only at pre-token boundaries.  ``docs``: row, doc_id, text."""
    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, tail = [], []
            for text, last in zip(batch["slice"].to_pylist(), batch["last"].to_pylist(), strict=True):
                found = boundaries(text, pattern, 0, len(text), last)
                head.append([b for b in found if b < overlap])
                tail.append([b - chunk for b in found if b >= chunk])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "head", "tail"])

    cut = _cut(docs, chunk, overlap).repartition("row", "chunk")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    order = W.partitionBy("row").orderBy("chunk")
    met = cut.mapInArrow(pretokenise, f"{schema}, head array<int>, tail array<int>") \
        .withColumn("start", F.array_min(F.array_intersect("head", F.lag("tail").over(order)))) \
        .withColumn("stop", F.lead("start").over(order)) \
        .withColumn("piece", F.count("start").over(order.rowsBetween(W.unboundedPreceding, 0)))
    begin = F.coalesce("start", F.lit(0))
    end = F.when(F.col("last"), F.length("slice")).otherwise(F.lit(chunk) + F.coalesce("stop", F.lit(0)))
    parts = met.select("row", "doc_id", "chunk", "piece", F.substring("slice", begin + 1, end - begin).alias("part"))
    return parts.groupBy("row", "piece").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("chunk", "part"))).alias("parts")) \
        .select("row", "doc_id", "piece", F.array_join(F.col("parts.part"), "").alias("part"))


def _encode_rows(rows: DataFrame, keep: list[str], text: str, path: str, pattern: str, overlap: int, digest: bool) -> DataFrame:
    """``keep`` plus ids and decoded bytes of ``text``, or plus n_tokens and both digests; piece by piece."""
    def encoded(bpe, value: str | None) -> list[int]:
        return [i for piece in pieces(value or "", pattern, max(1, overlap), overlap // 4) for i in bpe.encode_ordinary(piece)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoding(path, pattern)
        decimal = _decimals(bpe.n_vocab)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            kept = [batch.column(c) for c in keep]
            if digest:
                counts, shas, raws = [], [], []
                for t in texts:
                    ids = encoded(bpe, t)
                    counts.append(len(ids))
                    shas.append(hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest())
                    raws.append(hashlib.sha256(bpe.decode_bytes(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(raws, pa.string())],
                                                 names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                ids = [encoded(bpe, t) for t in texts]
                raws = [bpe.decode_bytes(x) for x in ids]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.list_(pa.int32())), pa.array(raws, pa.binary())],
                                                 names=[*keep, "ids", "decoded"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded binary"
    return rows.mapInArrow(encode, f"{schema}, {out}")


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, digest: bool = False,
                     chunk: int = CHUNK, overlap: int = OVERLAP, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) of every text, by the ranks in ``path``; no special tokens.

    ``digest``: n_tokens, ids_sha256 and decoded_sha256 (lowercase hex; ids as decimals joined by a space) in place
    of the ids and bytes.  Null and empty texts have no tokens.  Each row is encoded for itself, so repeated rows
    and rows with a null id give a row each.  Other columns are not read.
    """
    path, pattern = path or default_ranks(), pattern or default_pattern()
    docs = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = F.length("text") > chunk
    short = _encode_rows(docs.filter(~long), ["doc_id"], "text", path, pattern, overlap, digest)
    rows = docs.withColumn("row", F.monotonically_increasing_id()).filter(long).select("row", "doc_id", "text")
    parts = _encode_rows(stitched_pieces(rows, pattern, chunk, overlap), ["row", "doc_id", "piece"], "part", path, pattern, overlap, False)
    # pieces are whole characters, so their bytes are text again
    whole = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.struct("piece", "ids", F.decode("decoded", "UTF-8").alias("bytes")))).alias("p")) \
        .select("doc_id", F.flatten("p.ids").alias("ids"), F.array_join("p.bytes", "").alias("decoded"))
    if digest:
        whole = whole.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                             F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                             F.sha2("decoded", 256).alias("decoded_sha256"))
    else:
        whole = whole.select("doc_id", "ids", F.col("decoded").cast("binary").alias("decoded"))
    return short.unionByName(whole)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and decoded (binary): the concatenated bytes of each row's ids; null ids decode to no bytes."""
    path, pattern = path or default_ranks(), pattern or default_pattern()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoding(path, pattern)
        for batch in batches:
            raws = [bpe.decode_bytes(ids or []) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(raws, pa.binary())], names=["doc_id", "decoded"])

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {id_type}, decoded binary")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens and the digests of ids and decoded bytes of every document."""
    return encode_documents(table(spark, sf_dir, "documents"), digest=True)
