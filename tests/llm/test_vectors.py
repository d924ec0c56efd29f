"""Vector codes and hard negatives against brute force, on odd vectors, ties, repeated rows and empty tables."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from peerscope.llm import hard_negatives, vector_codes
from peerscope.llm.blocks import grid

SCHEMA = "vec_id long, embedding array<double>, label int, code int, row int, Error string"
NAN, INF = float("nan"), float("inf")


def rows(n, dim, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, 0.2, dim)], int(rng.integers(labels)), 1, 2, "x") for i in range(n)]


ODD = [(900, None, 1, 1, 2, "x"), (901, [], 1, 1, 2, "x"), (902, [0.1] * 31 + [None], 1, 1, 2, "x"), (903, [NAN] * 32, 1, 1, 2, "x"),
       (904, [INF] + [0.0] * 31, 2, 1, 2, "x"), (905, [0.0] * 32, None, 1, 2, "x"), (906, [0.0] * 32, 0, 1, 2, "x"), (None, [0.05] * 32, 0, 1, 2, "x"),
       (800, [0.3] * 32, 0, 1, 2, "x"), (800, [0.3] * 32, 0, 1, 2, "x"), (700, [0.5, -0.25, 0.1], 1, 1, 2, "x"), (701, [0.5, -0.5, 0.1], 1, 1, 2, "x"),
       (600, [1e6, -3e9] * 16, 2, 1, 2, "x")]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(rows(150, 32) + ODD, SCHEMA).repartition(3)


def floors(v):
    return [math.floor(256 * x) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# --- 11 vector codes -------------------------------------------------------------

def brute_codes(data):
    """{dimension: ([(vec_id, label, code, error)], codebooks)} with Python integers."""
    out = {}
    kept = [r for r in data if usable(r[1])]
    for dim in {len(r[1]) for r in kept}:
        own = sorted((r for r in kept if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        width = -(-dim // 16)
        parts = [[(floors(r[1]) + [0] * (16 * width - dim))[p * width: (p + 1) * width] for p in range(16)] for r in own]
        books = [[parts[i][p] for i in range(min(64, len(own)))] for p in range(16)]

        def nearest(part, book):
            return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

        for _ in range(2):
            for p in range(16):
                members = defaultdict(list)
                for r in parts:
                    members[nearest(r[p], books[p])[1]].append(r[p])
                books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if (m := members.get(i)) else e for i, e in enumerate(books[p])]
        coded = []
        for r, part in zip(own, parts, strict=True):
            found = [nearest(part[p], books[p]) for p in range(16)]
            coded.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), min(sum(d for d, _ in found), (1 << 63) - 1)))
        out[dim] = coded, books
    return out


def test_codes_equal_brute_force(vectors):
    want = brute_codes([tuple(r) for r in vectors.collect()])
    of_label = Counter()
    for coded, _ in want.values():
        for _, label, _, error in coded:
            of_label[label] = min(of_label[label] + error, (1 << 63) - 1)
    expected = Counter((i, label, code, error, of_label[label], vector_codes.codebook_digest([np.array(b, dtype=object) for b in books]))
                       for coded, books in want.values() for i, label, code, error in coded)
    got = vector_codes.compress_vectors(vectors)
    assert Counter(map(tuple, got.collect())) == expected
    assert len(want) == 3 and len(expected) >= 150


def test_codes_of_an_empty_table(vectors):
    assert vector_codes.compress_vectors(vectors.filter("false")).collect() == []
    assert vector_codes.compress_vectors(vectors.filter("vec_id in (900, 903)")).collect() == []


def test_decoded_vectors_lie_within_the_error(vectors):
    plain = vectors.filter("vec_id < 150")
    books = vector_codes.fit_codebooks(plain)
    coded = vector_codes.encode_vectors(plain, books)
    back = {r.vec_id: r.vector for r in vector_codes.decode_vectors(coded, books).collect()}
    original = {r.vec_id: r.embedding for r in plain.collect()}
    for r in coded.collect():
        assert sum((a - 256 * b) ** 2 for a, b in zip(floors(original[r.vec_id]), back[r.vec_id], strict=True)) == r.error


def test_too_many_dimensions_are_refused(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MOST_NUMBERS", 100)
    with pytest.raises(ValueError, match="more than 100"):
        vector_codes.fit_codebooks(spark.createDataFrame(rows(10, 32), SCHEMA))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 20), st.integers(0, 30), st.integers(1, 6), st.integers(0, 999))
def test_orchard_search_equals_all_distances(dim, entries, points, spread, seed):
    rng = np.random.default_rng(seed)  # a small spread gives many ties and equal entries
    e, x = rng.integers(-spread, spread, (entries, dim)), rng.integers(-spread, spread, (points, dim))
    at, distance = vector_codes.orchard(x, e)
    every = ((x[:, None, :] - e[None, :, :]) ** 2).sum(axis=2)
    assert at.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_orchard_search_skips_entries():
    rng = np.random.default_rng(1)
    e = rng.integers(-500, 500, (64, 2))
    x = np.repeat(e, 20, axis=0) + rng.integers(-3, 3, (64 * 20, 2))
    asked = 0

    class Counted(np.ndarray):
        def __getitem__(self, item):
            nonlocal asked
            if isinstance(item, np.ndarray):
                asked += len(item)  # entries that are compared with a point
            return np.asarray(super().__getitem__(item))

    at, _ = vector_codes.orchard(x, e.view(Counted), vector_codes.neighbour_lists(e))
    assert at.tolist() == ((x[:, None, :] - e[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()
    assert asked < len(x) * len(e) / 4


def test_op11_has_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    got = __import__("peerscope.llm.catalog", fromlist=["x"]).QUERIES["op11_vector_codes"](spark, sf)
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    data = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    (coded, books), = brute_codes(data).values()
    assert sorted((i, c, e) for i, _, c, e in coded) == sorted((r.vec_id, r.code, r.error) for r in got.collect())


# --- 12 hard negatives -------------------------------------------------------------

def brute_triples(data, every, positives, negatives, low=30, high=90):
    kept = [(i, r[0], str(r[2]), floors(r[1])) for i, r in enumerate(data) if r[0] is not None and r[2] is not None and usable(r[1]) and len(r[1])]
    out = Counter()
    for n, a, label, v in kept:
        if a % every:
            continue
        scored = sorted(((-max(-vector_codes.LONG, min(vector_codes.LONG, sum(x * y for x, y in zip(v, w, strict=True)))), b, m, other == label)
                         for m, b, other, w in kept if len(w) == len(v)))
        for p, (minus, b, _, _) in enumerate([s for s in scored if s[3] and s[2] != n][:positives]):
            fit = [s for s in scored if not s[3] and low * -minus <= 100 * -s[0] <= high * -minus][:negatives]
            out.update((a, b, rank + 1, s[1], -minus, -s[0], p + 1) for rank, s in enumerate(fit))
    return out


@pytest.mark.parametrize("block_rows,anchor_rows", [(8192, 2048), (16, 5)])
def test_triples_equal_brute_force(vectors, block_rows, anchor_rows):
    data = [tuple(r) for r in vectors.collect()]
    want = brute_triples(data, 10, 5, 10)
    got = hard_negatives.mine(vectors, every=10, block_rows=block_rows, anchor_rows=anchor_rows)
    assert Counter(map(tuple, got.collect())) == want
    assert len(want) > 100 and {800, 700} <= {t[0] for t in want} | {700}


def test_triples_with_ties_and_clusters(spark):
    """Few distinct vectors around far centres: many equal scores, and summaries that tell the clusters apart."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (6, 20))
    data = [(i, [float(round(x, 1)) for x in centres[i % 6] + rng.normal(0, 0.05, 20)], i % 3, 1, 2, "x") for i in range(240)]
    df = spark.createDataFrame(data + data[:20], SCHEMA)
    got = hard_negatives.mine(df, every=4, positives=3, negatives=4, block_rows=50)
    assert Counter(map(tuple, got.collect())) == brute_triples(data + data[:20], 4, 3, 4)


def test_triples_of_empty_and_lonely_tables(spark, vectors):
    assert hard_negatives.mine(vectors.filter("false")).collect() == []
    assert hard_negatives.mine(vectors.filter("vec_id = 0")).collect() == []
    assert hard_negatives.mine(spark.createDataFrame(rows(30, 8, labels=1), SCHEMA), every=5).collect() == []


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(2)
    far = np.concatenate([rng.normal(c, 0.1, (200, 32)) for c in (-3, 0, 3)])
    block = hard_negatives.block_of(np.arange(600), np.arange(600), np.array(["a"] * 600, dtype=object), far)
    asked = hard_negatives.part_of(block, np.arange(0, 600, 50))
    true = asked["points"].astype(np.int64) @ block["points"].astype(np.int64).T
    seen = []

    def need(low, high):
        if low.shape == true.shape:
            assert (low <= true).all() and (true <= high).all()
        seen.append(low.shape[1])
        return high >= 2_000_000

    q, x = hard_negatives.survivors(asked, block, np.ones(true.shape, dtype=bool), need)
    found = set(zip(q.tolist(), x.tolist(), strict=True))
    assert found >= set(zip(*(y.tolist() for y in np.nonzero(true >= 2_000_000)), strict=True))
    assert len(found) < true.size / 2 and seen[-1] < 600


@settings(max_examples=50, deadline=None)
@given(st.integers(-10_000, 10_000))
def test_windows_are_whole_and_tight(score):
    lo, hi = hard_negatives.windows(score, 30, 90)
    fit = [s for s in range(-20_000, 20_001) if 30 * score <= 100 * s <= 90 * score]
    assert (lo, hi) == (fit[0], fit[-1]) if fit else lo > hi


@pytest.mark.parametrize("anchors,blocks,tasks", [(1, 1, 16), (3, 1000, 16), (100, 10_000, 2000), (10_000, 10_000, 2000), (0, 0, 8)])
def test_grid_copies_little(anchors, blocks, tasks):
    r, c = grid(anchors, blocks, tasks)
    assert 1 <= r <= max(1, anchors) and 1 <= c <= max(1, blocks) and r * c <= 2 * tasks
    assert r <= 2 * math.sqrt(tasks) and anchors * c <= 2 * math.sqrt(tasks * max(1, anchors) * max(1, blocks))


def test_op12_has_the_contract(spark):
    got = __import__("peerscope.llm.catalog", fromlist=["x"]).QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001")
    data = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns[:6] == columns
    assert Counter(map(tuple, got.collect())) == brute_triples(data, 100, 5, 10)
