"""Packing into training sequences: first-fit decreasing on a tournament tree, in randomised groups of documents.

Every document becomes its tokenizer's ids and an end id.  Its full runs of ``capacity`` ids are sequences of their
own; the rests are dealt at random over groups of about ``GROUP_ROWS`` documents, and each group is packed for itself.
Rests come largest first; each goes to the first bin with enough room, which a tournament tree of the bins' room finds:
an inner node holds the largest room below it, so the search goes to the left wherever the left side has enough.

A sequence is padded to ``capacity`` unless its length is a power of two, and documents may be cut, so what a group
leaves open is closed afterwards: the emptiest bins are cut up to fill the gaps of at least ``LEAST_CUT`` ids of the
fullest ones, and the one bin left over is cut into runs whose lengths are powers of two.

The ids travel once, to their group, in as few bytes as the vocabulary needs; a task holds one group at a time.
"""

from __future__ import annotations

import math
import os
import re
import struct
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from peerscope.llm.shared import table

CAPACITY = 2048
END = 1
GROUP_ROWS = 2048
LEAST_CUT = 64
KNOWN_WORDS = 1_000_000  # words a Python worker remembers
KNOWN_LENGTH = 64  # letters of a word worth remembering
BLOCK = 1_000_000  # characters looked at together
TOGETHER = 1000  # unseen words encoded in one call
CLOSING = ".,;:!?$%&*#)]}\">/"
ALNUM = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(map(chr, range(0xC0, 0x100))) - {"×", "÷"}

_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARK = re.compile("[\u0300-\u036f]")

Part = tuple[int, int, int]  # item, first id, ids


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- ids --------------------------------------------------------------------

@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


@cache
def _known_words(path: str) -> dict[str, bytes]:
    return {}


@cache
def _width(path: str) -> str:
    """The narrowest little-endian numbers that hold every id."""
    return "<u2" if _tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


@cache
def _ends(path: str) -> np.ndarray | None:
    """Whether an id ends a piece; None: the tokenizer does not tell."""
    tokenizer = _tokenizer(path)
    if not (suffix := getattr(tokenizer.model, "end_of_word_suffix", None)):
        return None
    out = np.zeros(1 << 16 if _width(path) == "<u2" else max(tokenizer.get_vocab().values()) + 1, dtype=bool)
    out[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
    return out


@cache
def _lowers(path: str) -> bool:
    """Whether the tokenizer takes A-Z for a-z."""
    normalizer = _tokenizer(path).normalizer
    return normalizer is not None and normalizer.normalize_str("ABCDEFGHIJKLMNOPQRSTUVWXYZ") == "abcdefghijklmnopqrstuvwxyz"


def _lowered(block: str) -> str:
    """A-Z in lower case, unless the block has combining marks: they join a letter before it is lowered."""
    try:
        return block.encode("latin-1").lower().decode("latin-1")
    except UnicodeEncodeError:
        return block if _MARK.search(block) else block.encode().lower().decode()


def _blocks(text: str) -> Iterator[str]:
    """The text in pieces of about ``BLOCK`` characters, cut at spaces."""
    start = 0
    while len(text) - start > BLOCK and (stop := text.find(" ", start + BLOCK)) >= 0:
        yield text[start:stop]
        start = stop
    yield text[start:]


def encoded(text: str | None, path: str) -> bytes:
    """The ids of a text as numbers of ``_width``, without an end id; a null has none.

    The tokenizer's pieces never cross white space, so a text is cut at spaces and line feeds and encoded word by word;
    a word that this Python process has seen, in whatever case, is not encoded again.
    """
    known, out = _known_words(path), []
    for block in _blocks(text or ""):
        block = _lowered(block) if _lowers(path) else block
        words = block.replace("\n", " ").split(" ")
        new = set(words).difference(known)
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = set(words)
        _learn(new, known, path)
        out += [known[w] for w in words]
        for w in new:
            if len(w) > KNOWN_LENGTH:
                del known[w]
    return b"".join(out)


def _learn(words: set[str], known: dict[str, bytes], path: str) -> None:
    """Encode words; closing marks behind a letter or digit are a piece of their own, so what they close is shared.

    Words of letters alone are one piece each: many are encoded in one call, and the ids that end a piece part them.
    """
    closed_by = {w: (stem, w[len(stem):]) for w in words if len(w) <= KNOWN_LENGTH and (stem := w.rstrip(CLOSING)) != w and stem and stem[-1] in ALNUM}
    plain = list({p for pair in closed_by.values() for p in pair}.difference(known) | words.difference(closed_by))
    letter = "H" if _width(path) == "<u2" else "I"
    fast = _tokenizer(path).encode_batch_fast  # the same ids, without offsets
    if (ends := _ends(path)) is not None:
        single = [w for w in plain if _LETTERS.fullmatch(w)]
        for i in range(0, len(single), TOGETHER):
            some = single[i: i + TOGETHER]
            ids = np.array(fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=_width(path))
            stops = (np.flatnonzero(ends[ids]) + 1) * ids.itemsize
            if len(stops) == len(some):
                raw, cuts = ids.tobytes(), stops.tolist()
                known.update((w, raw[a:b]) for w, a, b in zip(some, [0, *cuts], cuts, strict=False))
        plain = [w for w in plain if w not in known]
    for w, e in zip(plain, fast(plain, add_special_tokens=False), strict=True):
        ids = e.ids
        known[w] = struct.pack(f"<{len(ids)}{letter}", *ids)
    for w, (stem, marks) in closed_by.items():
        known[w] = known[stem] + known[marks]


def tokenise(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(row, doc_id, ids) of every row: ``ids`` as numbers of ``_width``, ``end`` last."""
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], dtype=_width(path)).tobytes()
        for batch in batches:
            held, size, start = [], 0, 0
            for i, t in enumerate(batch["text"]):
                held.append(encoded(t.as_py(), path) + last)
                size += len(held[-1])
                if size > 8_000_000 or i == batch.num_rows - 1:
                    part = batch.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([part["row"], part["doc_id"], pa.array(held, pa.binary())], names=["row", "doc_id", "ids"])
                    held, size, start = [], 0, i + 1

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(ids, f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


# --- one group ----------------------------------------------------------------

class Tournament:
    """Room of ``n`` bins: leaves in order, every inner node with the largest room below it."""

    def __init__(self, n: int, capacity: int) -> None:
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first bin with room for ``size`` ids."""
        at, room = 1, self.room
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        return at - self.leaves

    def take(self, bin_: int, size: int) -> None:
        at, room = bin_ + self.leaves, self.room
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Items of each bin; an item of at most ``capacity`` goes to the first bin with room, larger items first."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = tree.first(sizes[item])
        tree.take(at, sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def _padded(size: int, capacity: int) -> int:
    """Padding of a sequence of ``size`` ids."""
    return 0 if size & (size - 1) == 0 else capacity - size


def closed(bins: list[list[Part]], capacity: int, least: int = LEAST_CUT) -> list[list[Part]]:
    """The bins with their gaps filled: the emptiest are cut up for the fullest, the last is cut into powers of two."""
    size = [sum(n for _, _, n in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (size[b], b))
    order = [b for b in order if _padded(size[b], capacity) and capacity - size[b] >= least]
    low, high = 0, len(order) - 1
    while low < high:
        donor, taker = order[low], order[high]
        gap = capacity - size[taker]
        while gap and bins[donor]:
            item, start, n = bins[donor].pop()
            here = min(gap, n)
            if here < n:
                bins[donor].append((item, start, n - here))
            bins[taker].append((item, start + n - here, here))
            size[taker] += here
            size[donor] -= here
            gap -= here
        high -= not gap
        low += not bins[donor]
    out = [b for b in bins if b]
    if low == high and (rest := bins[order[low]]) and _padded(size[order[low]], capacity):
        out.remove(rest)
        left = size[order[low]]
        while left:
            run, left_in = [], 1 << (left.bit_length() - 1)
            left -= left_in
            while left_in:
                item, start, n = rest.pop(0)
                here = min(left_in, n)
                run.append((item, start, here))
                if here < n:
                    rest.insert(0, (item, start + here, n - here))
                left_in -= here
            out.append(run)
    return out


def pack_group(sizes: Sequence[int], capacity: int) -> list[list[Part]]:
    """Sequences of one group of documents, as lists of (item, first id, ids)."""
    full = [[(i, k, capacity)] for i, n in enumerate(sizes) for k in range(0, n - capacity + 1, capacity)]
    rest = [(i, n - n % capacity, n % capacity) for i, n in enumerate(sizes) if n % capacity]
    bins = first_fit_decreasing([n for _, _, n in rest], capacity)
    return full + closed([[rest[i] for i in b] for b in bins], capacity)


# --- whole tables ---------------------------------------------------------------

def pack_sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
                   key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: a row for each piece of each document.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers, ``start`` counts the document's ids before
    it, ``doc_tokens`` all of them, the end id included.  Null, empty and blank texts are their end id alone; a
    document of any length is cut into as many pieces as it needs.  Repeated rows and rows with a null or repeated id
    are packed each for itself.  Documents of equal length keep the order of their rows.  An empty table gives an
    empty result; other columns are not read.
    """
    path = tokenizer or default_tokenizer()
    groups = max(1, math.ceil(docs.count() / group_rows))
    tokens = tokenise(docs, path, key, text, end).withColumn("group", F.pmod(F.xxhash64("row", F.lit("group")), F.lit(groups)))
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def packed(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.sort_by("row")
        number, width = group["group"][0].as_py() << 32, _width(path)
        whole = [np.frombuffer(x, dtype=width) for x in group["ids"].to_pylist()]
        ids_of, rows, size = group["doc_id"].combine_chunks(), [], 0
        last = len(found := pack_group([len(x) for x in whole], capacity)) - 1
        for s, sequence in enumerate(found):
            offset = 0
            for item, start, length in sequence:
                raw = whole[item][start: start + length].astype("<u4").tobytes()
                rows.append((item, start, length, raw, len(whole[item]), number + s, offset))
                offset += length
                size += length
            if size > 1_000_000 or s == last:
                item, *rest = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(item)), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                rows, size = [], 0

    def of_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(pa.Table.from_batches(batches))

    return tokens.groupBy("group").applyInArrow(
        of_group, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, ids (array of long), n_ids, n_padded: the assembled training sequences of ``pack_sequences``."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.concatenate([np.frombuffer(x["ids"], dtype="<u4") for x in p]).astype(np.int64) for p in batch["p"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["sequence_id"], pa.array(ids, pa.list_(pa.int64())), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([_padded(len(x), capacity) for x in ids], pa.int64())], names=["sequence_id", "ids", "n_ids", "n_padded"])

    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))  # at most capacity ids
    return whole.mapInArrow(unpacked, "sequence_id long, ids array<long>, n_ids long, n_padded long")


def op13_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, with the checksum of its ids."""
    return pack_sequences(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
