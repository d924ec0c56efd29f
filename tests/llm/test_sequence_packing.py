"""Packing into training sequences: ids as the tokenizer gives them, whole documents, little padding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from peerscope.llm import sequence_packing as packing

SCHEMA = "doc_id long, text string, ids int, Sequence_Id int, start string, row int"
TEXTS = [None, "", " \n\t ", "a", "It's  THE\tend.\r\nof 1234 it!", "<|endoftext|> x <|startoftext|>", "Ünï çödé 漢字 🙂 é ́x ñ",
         " ".join(f"w{i}" for i in range(9000)), "x" * 5000, " nbsp em\x1cfs\x85nel", "a", "o'clock we'll I'm\n\n\nOK" * 40]


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, t, 1, 2, "s", 3) for i, t in enumerate(TEXTS)] + [(3, "a", 1, 2, "s", 3), (None, "no id", 1, 2, "s", 3), (None, None, 1, 2, "s", 3)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def tokenizer():
    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return t


def check(pieces, docs, capacity=packing.CAPACITY):
    """The contract: every id of every document in one piece, sequences gapless and at most ``capacity`` long."""
    t = tokenizer()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids + [1])] += 1
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert len(ids) == r.length > 0
        parts[r.doc_id, r.doc_tokens].append((r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    for of in sequences.values():
        at = 0
        for offset, length in sorted(of):
            assert offset == at
            at += length
        assert at <= capacity
    for (doc_id, n), found in parts.items():  # rows with one id and one length are told apart by their ids
        docs_here = {k[1]: m for k, m in want.items() if k[0] == doc_id and len(k[1]) == n}
        assert sum(len(ids) for _, ids in found) == n * sum(docs_here.values())
        for start, ids in found:
            assert any(list(d[start: start + len(ids)]) == ids for d in docs_here)
        assert Counter(p for s, ids in found for p in range(s, s + len(ids))) == dict.fromkeys(range(n), sum(docs_here.values()))
    assert {(k[0], len(k[1])) for k in want} == set(parts)
    return [sum(n for _, n in of) for of in sequences.values()]


@pytest.mark.parametrize("capacity,group_rows", [(2048, 2048), (64, 4), (1, 3)])
def test_every_id_is_packed_once(docs, capacity, group_rows):
    small = docs if capacity > 1 else docs.filter("length(text) < 100 or text is null")
    lengths = check(packing.pack_sequences(small, capacity=capacity, group_rows=group_rows), small, capacity)
    assert sum(packing._padded(n, capacity) for n in lengths) < max(0.05 * sum(lengths), packing.LEAST_CUT * len(lengths) * (capacity > 64))


def test_empty_table(docs):
    assert packing.pack_sequences(docs.filter("false")).collect() == []


@pytest.mark.parametrize("block", [packing.BLOCK, 7])
def test_word_by_word_equals_the_tokenizer(monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 40)
    rng, t, path = random.Random(4), tokenizer(), packing.default_tokenizer()
    letters = ["a", "B", "'s", "'", "!", "9", " ", "\n", "\t", "\r", " ", "́", "é", "ς", "Σ", "İ", "漢", "\x1c", "​", "<|endoftext|>", "ﬁ", ".", "..", "?!", "$%&*", ",", ":;"]
    for text in TEXTS + ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(400)]:
        ids = np.frombuffer(packing.encoded(text, path), dtype=packing._width(path)).tolist()
        assert ids == t.encode(text or "", add_special_tokens=False).ids, repr(text)


def naive_first_fit(sizes, capacity):
    bins, room = [], []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, r in enumerate(room) if r >= sizes[item]), len(bins))
        if at == len(bins):
            bins.append([])
            room.append(capacity)
        bins[at].append(item)
        room[at] -= sizes[item]
    return bins


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.sampled_from([40, 64]))
def test_tournament_tree_is_first_fit_decreasing(sizes, capacity):
    assert packing.first_fit_decreasing(sizes, capacity) == naive_first_fit(sizes, capacity)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=40), st.sampled_from([32, 60, 128]), st.integers(1, 20))
def test_closing_keeps_every_id_and_leaves_small_gaps(sizes, capacity, least):
    rest = [(i, 0, n) for i, n in enumerate(sizes) if 0 < n <= capacity]
    bins = packing.first_fit_decreasing([n for _, _, n in rest], capacity)
    out = packing.closed([[rest[i] for i in b] for b in bins], capacity, least)
    assert Counter((i, p) for b in out for i, s, n in b for p in range(s, s + n)) == Counter((i, p) for i, _, n in rest for p in range(n))
    totals = [sum(n for _, _, n in b) for b in out]
    assert all(0 < n <= capacity for n in totals)
    assert all(packing._padded(n, capacity) < least for n in totals)


def test_assembled_sequences(docs):
    pieces = packing.pack_sequences(docs)
    whole = packing.sequences(pieces).collect()
    assert sum(r.n_ids for r in whole) == sum(r.length for r in pieces.collect())
    assert all(len(r.ids) == r.n_ids <= 2048 and r.n_padded == (0 if r.n_ids & (r.n_ids - 1) == 0 else 2048 - r.n_ids) for r in whole)


def test_op13_has_the_contract(spark):
    from peerscope.llm.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op13_sequence_packing"](spark, sf)
    assert dict(got.dtypes) == dict.fromkeys(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], "bigint")
    t, rows = tokenizer(), got.collect()
    ids = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start: r.start + r.length], dtype="<u4").tobytes())
    lengths = check(packing.pack_sequences(docs), docs)
    assert sum(packing._padded(n, 2048) for n in lengths) < 0.01 * sum(lengths)


def test_words_are_encoded_once_whatever_their_case_and_closing_marks():
    path, known = packing.default_tokenizer(), packing._known_words(packing.default_tokenizer())
    known.clear()
    text = "Stone STONE stone### (Stone) çédé, ÇÉDÉ"
    want = tokenizer().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoded(text, path), dtype=packing._width(path)).tolist() == want
    assert "stone" in known and "###" in known and "Stone" not in known and "STONE" not in known and "çédé" in known
    for odd in ("H̱a ẖa", "İ. İst", "x̸. ≠", "é. É#", "a'. 'S) it'S]", "</w> A</w>", "\xd7# \xaa) \xb5]"):
        want = tokenizer().encode(odd, add_special_tokens=False).ids
        assert np.frombuffer(packing.encoded(odd, path), dtype=packing._width(path)).tolist() == want
