"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from peerscope.llm import ann, blocks, bpe, kdtree, line_dedup, minhash_dedup, packing, sharding, substring_dedup, toxicity, url_filter

LONG = " ".join(f"w{i}" for i in range(9000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
LINES = "one line here\nsecond line there\nthird line of it"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts):
    return [(i, t, ("en", "de", None)[i % 3], (None, "src0", "src1")[i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]


TEXTS = [None, "", " \t ", "a", LONG, f"x {PASSAGE} y", f"z {PASSAGE}", LINES, LINES + "\nlast", f"{LINES}\n\n\n\n{LINES}", "a", LONG + " end", "Ünï çödé 漢字 🙂", "\n\n\n\n\n"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, a row twice, a row without an id, and columns named like the operators' own."""
    from pyspark.sql import functions as F

    data = rows(TEXTS) + [(3, "a", "en", None, 1), (None, "no id", None, None, 5), (None, LINES, "en", "src0", 1)]
    extra = {c: F.lit(1) for c in ("n_words", "score", "bin_id", "row", "group", "hash", "Kept", "n_lines", "rejected", "covered", "set")}
    return spark.createDataFrame(data, SCHEMA).withColumns(extra)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(12)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")


def words(text):
    return (text or "").encode().split()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def collected(df):
    return [r.asDict() for r in df.collect()]


# --- 1 BPE --------------------------------------------------------------------

@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (200, 40), (16, 8)])
def test_bpe_equals_the_library_and_round_trips(docs, chunk, overlap):
    want = Counter()
    whole = bpe._encoding(bpe.default_ranks(), bpe.default_pattern())
    for r in docs.collect():
        ids = whole.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(r.text or "")] += 1
    got = bpe.encode_documents(docs, digest=True, chunk=chunk, overlap=overlap)
    assert Counter(map(tuple, got.collect())) == want
    ids = bpe.encode_documents(docs, chunk=chunk, overlap=overlap)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in bpe.decode_documents(ids).collect()) == \
        Counter((r.doc_id, (r.text or "").encode()) for r in docs.collect())


@pytest.mark.parametrize("text", ["a" * 500, " " * 300 + "x", "x" + " \n" * 200 + "y", "ab'll " * 100, "12 34" * 90, "漢" * 300 + ". " + "字" * 90, "\x1c" * 90 + "a b"])
def test_bpe_runs_without_a_common_boundary(spark, text):
    whole = bpe._encoding(bpe.default_ranks(), bpe.default_pattern())
    got = bpe.encode_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), chunk=32, overlap=8).first()
    assert got.ids == whole.encode_ordinary(text) and bytes(got.decoded).decode() == text


def test_bpe_short_texts_are_encoded_by_stitched_pieces(spark):
    whole = bpe._encoding(bpe.default_ranks(), bpe.default_pattern())
    texts = [("It's 12 o'clock,\n\n  she'll say 漢字 🙂.. " * 700)[:n] for n in (1024, 1400, 5000, 20_000)] + ["b " * 900 + "a" * 3000 + " c" * 900]
    for text in texts:
        cut = bpe.pieces(text, bpe.default_pattern(), 1024, 256)
        assert "".join(cut) == text and [i for p in cut for i in whole.encode_ordinary(p)] == whole.encode_ordinary(text)
        assert (len(cut) > 1) == (len(text) > 1024)
    got = bpe.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.ids for r in got} == dict(enumerate(map(whole.encode_ordinary, texts)))


def test_bpe_empty_table(empty):
    assert bpe.encode_documents(empty, digest=True).collect() == []


# --- 2 URL filter ---------------------------------------------------------------

URLS = {
    "http://a.NET/x": ("a.net", "/x", "net/", "block"), "https://m.example.net/en/1?q#f": ("m.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/de/": ("example.net", "/de/", "net/", "block"), "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
    "http://x.org/fr/a": ("x.org", "/fr/a", "org/fr/", "allow"), "ftp://badnet/": ("badnet", "/", None, None), "http://a.net": ("a.net", "", None, None),
    "http://a.net?x=/y": ("a.net", "", None, None), "no address": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
    "http://ÄB.org/FR/": ("Äb.org", "/FR/", None, None), "x://y://net/": ("y:", "//net/", None, None), "http://é\n.net/a\nb": ("é\n.net", "/a\nb", "net/", "block"),
    "http://h.example/" + "p" * 50_000: ("h.example", "/" + "p" * 50_000, None, None),
}


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)] * 2, "page_id long, url string, host string, Score int")
    got = url_filter.judge_urls(pages).toDF("page_id", "url", "h", "s", "host", "path", "rule", "verdict", "score").collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, verdict = URLS[r.url]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert url_filter.judge_urls(pages.filter("false")).collect() == []


def test_url_model_learns_its_table_and_matches_numpy(spark):
    import zlib

    labelled = spark.createDataFrame(url_filter.LABELLED, "url string, label int")
    weights, bias = url_filter.train(labelled)
    judged = url_filter.judge_urls(labelled.withColumnRenamed("label", "y")).collect()
    assert np.mean([(r.score >= 0.5) == (r.y == 1) for r in judged]) >= 0.95

    def features(host, path):
        grams = {k + f"^{t}$"[i: i + 4] for k, t in (("h", host), ("p", path)) for i in range(max(1, len(t) - 1))}
        return sorted({zlib.crc32(g.encode()) % url_filter.DIMENSIONS for g in grams})

    x = [features(r.host, r.path) for r in judged]
    w, b, y = np.zeros(url_filter.DIMENSIONS), 0.0, np.array([r.y for r in judged])
    for _ in range(url_filter.EPOCHS):
        e = (y - 1 / (1 + np.exp(-np.array([b + w[f].sum() / len(f) ** 0.5 for f in x])))) * url_filter.RATE / len(x)
        w *= 1 - url_filter.DECAY
        b = b * (1 - url_filter.DECAY) + e.sum()
        for f, p in zip(x, e, strict=True):
            w[f] += p / len(f) ** 0.5
    assert np.allclose(w, weights, atol=1e-9) and abs(b - bias) < 1e-9
    assert url_filter.train(labelled.filter("false")) == ([0.0] * url_filter.DIMENSIONS, 0.0)


# --- 3 substring dedup ------------------------------------------------------------

def brute_repeats(texts, width):
    seen = Counter(tuple(w[p: p + width]) for w in texts for p in range(len(w) - width + 1))
    out = []
    for w in texts:
        gone = np.zeros(len(w), dtype=bool)
        for p in range(len(w) - width + 1):
            if seen[tuple(w[p: p + width])] > 1:
                gone[p: p + width] = True
        out.append((len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("width,group_bytes", [(35, 4_000_000), (35, 500), (4, 300), (3, 50)])
def test_substring_dedup_equals_brute_force(docs, width, group_bytes):
    data = docs.collect()
    want = Counter((r.doc_id, r.text, *x) for r, x in zip(data, brute_repeats([words(r.text) for r in data], width), strict=True))
    got = substring_dedup.remove_repeats(docs, width=width, group_bytes=group_bytes)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert Counter((r.doc_id, r.text, *r[-3:]) for r in got.collect()) == want


def test_substring_dedup_one_word_over_and_over(spark, empty):
    df = spark.createDataFrame([(1, "la " * 500), (2, "la " * 34)], "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(df).collect()} == \
        {1: (500, 500, ""), 2: (34, 0, ("la " * 34).strip())}
    assert substring_dedup.remove_repeats(empty).collect() == []


# --- 4 line dedup -------------------------------------------------------------------

def test_line_dedup_equals_brute_force(docs, empty):
    data = docs.collect()
    windows = {}
    for r in data:
        lines = [] if r.text is None else r.text.split("\n")
        for i in range(len(lines) - 2):
            if (w := tuple(lines[i: i + 3])) and "".join(w).strip(" \t\r\x0b\x0c"):
                windows.setdefault(w, set()).add((r.doc_id is None, r.doc_id or 0, r.text, i))
    want = Counter()
    for r in data:
        lines = [] if r.text is None else r.text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            if (found := windows.get(tuple(lines[i: i + 3]))) and min(found, key=lambda x: (x[0], x[1], x[3])) != (r.doc_id is None, r.doc_id or 0, r.text, i):
                gone |= {i, i + 1, i + 2}
        want[r.doc_id, None if r.text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)] += 1
    got = line_dedup.dedup_lines(docs)
    assert Counter((r.doc_id, r.text, *r[-2:]) for r in got.collect()) == want
    assert line_dedup.dedup_lines(empty).collect() == []


# --- 5 toxicity -----------------------------------------------------------------------

def test_toxicity_cases(docs, empty, labels):
    got = collected(toxicity.score_documents(docs, labels).toDF(*docs.columns, "s", "r"))
    assert len(got) == docs.count() and all(0 <= r["s"] <= 1 for r in got)
    by_text = {}
    for r in got:
        assert abs(by_text.setdefault(r["text"], r["s"]) - r["s"]) < 1e-6  # single precision, in other batches
    assert abs(by_text[None] - by_text[""]) < 1e-6
    none = toxicity.score_documents(docs, labels.filter("false")).toDF(*docs.columns, "s", "r").collect()
    assert {(r.s, r.r) for r in none} == {(0.0, False)}
    assert toxicity.score_documents(empty, labels).collect() == []


def test_toxicity_network_gradient():
    """One small step down the gradient lowers the loss."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 50, (n, 2)) for n in (5, 1, 9, 30)]
    y = np.array([1, 0, 1, 0])
    model = toxicity.Classifier()
    model.trained = True
    model.words[:50] = rng.normal(0, 1, (50, toxicity.SIZE))
    loss = []
    grown = {"words": np.full_like(model.words, 100), "filters": [np.full_like(f, 100) for f in model.filters],
             "shift": [np.full_like(s, 100) for s in model.shift], "top": np.full_like(model.top, 100), "bias": 100}
    for _ in range(20):
        p = np.clip(model.score(texts), 1e-9, 1 - 1e-9)
        loss.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
        model._step(texts, y, grown)
    assert all(b < a for a, b in zip(loss, loss[1:]))


# --- 6 packing --------------------------------------------------------------------------

def naive_pack(sizes, sources, clusters, capacity):
    bins, out = [], []
    for r, s in enumerate(sizes):
        for k in range(s // capacity):
            out.append(((r, k, k * capacity, capacity), len(bins), 0))
            bins.append([0, set(), set()])
    rest = [(r, s // capacity, s - s % capacity, s % capacity) for r, s in enumerate(sizes) if s % capacity or not s]
    for p in sorted(rest, key=lambda p: (-p[3], p[0])):
        r, size = p[0], p[3]
        fits = [(b[0], i) for i, b in enumerate(bins) if len(b) == 4 and b[0] >= size and sources[r] not in b[1] and clusters[r] not in b[2]]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append([capacity, set(), set(), True])
        out.append((p, i, capacity - bins[i][0]))
        bins[i][0] -= size
        bins[i][1] |= {sources[r]} - {None}
        bins[i][2] |= {clusters[r]} - {None}
    return out


def test_best_fit_equals_naive_search():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 300):
        sizes = rng.integers(0, 60, n).tolist()
        sources = [None if x == 9 else f"s{x % 4}" for x in rng.integers(0, 10, n)]
        clusters = [None if x > 40 else x for x in rng.integers(0, 60, n).tolist()]
        assert packing.best_fit(sizes, sources, clusters, 25) == naive_pack(sizes, sources, clusters, 25)


def test_packing_places_every_word_once(docs, empty):
    got = packing.pack_documents(docs, capacity=64, shard_rows=5).collect()
    bins = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    for pieces in bins.values():
        pieces.sort(key=lambda r: (r.bin_offset, r.n_words))
        assert sum(r.n_words for r in pieces) <= 64
        assert all(a.bin_offset + a.n_words <= b.bin_offset for a, b in zip(pieces, pieces[1:]))
        named = [r.source for r in pieces if r.source is not None]
        assert len(named) == len(set(named))
    assert Counter((r.doc_id, r.start_word, r.n_words) for r in got) == Counter(
        (d.doc_id, a, min(64, len(words(d.text)) - a)) for d in docs.collect() for a in range(0, max(1, len(words(d.text))), 64))
    assert packing.pack_documents(empty).collect() == []


def test_copies_go_into_different_bins(spark, tmp_path):
    """Near copies with ``near``; the query keeps equal texts apart."""
    base = " ".join(f"n{i}" for i in range(120))
    texts = [base, base + " one", base + " two", base.upper(), base, "far " * 3, "", None]
    data = [(None if i == 2 else i // 2, t, "en", f"s{i}", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, SCHEMA).coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = packing.pack_documents(docs, near=True).collect()
    assert sorted(r.source for r in got) == sorted(d[3] for d in data)
    alike = [r.bin_id for r in got if r.n_words > 100]
    assert len(alike) == 5 == len(set(alike)) == len({r.bin_id for r in got})
    bins = {r.source: r.bin_id for r in packing.op6_packing(spark, str(tmp_path)).collect()}
    assert bins["s0"] != bins["s4"] and len(set(bins.values())) == 2


# --- 7 and 8 vectors -----------------------------------------------------------------------

def vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(0, 1, 6).tolist()) for i in range(180)]
    data += [(i, [0.5, -0.25, 1.0, 0.0, 2.0, -1.0]) for i in range(180, 240)]  # ties
    data += [(250, None), (300, []), (350, [0.0] * 6), (400, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (450, [float("nan")] * 6),
             (500, [float("inf")] * 6), (None, [1.0] * 6), (550, [1.0, 2.0]), (551, [2.0, 1.0]), (100, data[100][1]), (100, data[100][1])]
    return data, spark.createDataFrame([(i, v, 0) for i, v in data], "vec_id long, embedding array<float>, score int")


def brute(data, score, usable):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all()]
    rows = [r for r in rows if usable(r[1])]
    out = Counter()
    for a, (i, x) in enumerate(rows):
        if i % 50 == 0:
            found = sorted((-score(x, y), j) for b, (j, y) in enumerate(rows) if a != b and len(x) == len(y))[:5]
            for n, (s, j) in enumerate(found, 1):
                out[i, n, j, round(-s, 9)] += 1
    return out


@pytest.mark.parametrize("block_rows", [8192, 16])
def test_neighbours_equal_brute_force(spark, block_rows):
    data, df = vectors(spark)
    unit = lambda x: x / np.sqrt((x / np.abs(x).max() * (x / np.abs(x).max())).sum()) / np.abs(x).max()
    want = brute(data, lambda x, y: round(float((unit(x) * unit(y)).sum()), 13), lambda x: x.any())
    got = ann.nearest_neighbours(df.repartition(3), block_rows=block_rows).collect()
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == want
    assert ann.nearest_neighbours(df.filter("false")).collect() == []


@pytest.mark.parametrize("block_rows", [8192, 16])
def test_top_products_equal_brute_force(spark, block_rows):
    data, df = vectors(spark)
    want = brute(data, lambda x, y: int((np.floor(256 * x) * np.floor(256 * y)).sum()), lambda x: True)
    got = kdtree.top_products(df.repartition(3), block_rows=block_rows).collect()
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert kdtree.top_products(df.filter("false")).collect() == []


def test_top_products_beyond_doubles(spark):
    rng = np.random.default_rng(8)
    data = [(0, [3e7, 1.0]), (1, [3e7, 2.0]), (2, [3e7, 1.0]), (3, [1e30, 0.0]), (4, [-3e7, 5.0]), (5, [2.0 ** 20, 2.0 ** 20 + 1 / 256])]
    data += [(i, [float(x) for x in rng.integers(-2 ** 22, 2 ** 22, 2) + rng.integers(0, 256, 2) / 256]) for i in range(6, 900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    points = {i: [int(np.floor(256 * x)) if abs(x) < 2 ** 50 else 256 * int(x) for x in v] for i, v in data}
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in kdtree.top_products(df).collect())
    want = []
    for q in range(0, 900, 50):
        scored = sorted((-max(-kdtree.LONG, min(kdtree.LONG, sum(a * b for a, b in zip(points[q], p)))), i) for i, p in points.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert got == want
    assert any(abs(s) > 1 << 53 for *_, s in want)


def test_queries_are_copied_little_whatever_the_shuffle_partitions(spark):
    """Blocks and query blocks travel about sqrt(tasks) times under any number of shuffle partitions, and results agree."""
    _, df = vectors(spark)
    want = Counter(map(tuple, kdtree.top_products(df, every=3, block_rows=8).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert Counter(map(tuple, kdtree.top_products(df, every=3, block_rows=8).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert blocks.grid(10_000, 10_000, 400) == (20, 20)


def test_tree_leaves_are_pruned():
    """Clustered points: the search looks at few leaves and still finds the best."""
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.01, (256, 4)) for c in rng.normal(0, 3, (16, 4))])
    shard = kdtree.tree(np.arange(len(points)), points, leaf=64)
    q = np.floor(256 * points[:3])
    best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * 3
    kdtree.search_tree({"points": q, "own": np.full(3, -1)}, shard, best)
    want = np.floor(256 * points) @ q.T
    for i in range(3):
        order = np.lexsort((np.arange(len(points)), -want[:, i]))[:5]
        assert best[i][1].tolist() == order.tolist()


# --- 9 near-dedup -----------------------------------------------------------------------------

def brute_components(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for r in docs:
        w = words((r.text or "").translate(low))
        sets[r.doc_id] = frozenset(tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(12):
        base = [f"v{x}" for x in rng.integers(0, 400, rng.integers(4, 120))]
        for _ in range(rng.integers(1, 9)):
            copy = list(base)
            for at in rng.integers(0, len(copy), rng.integers(0, 1 + len(copy) // 20)):
                copy[at] = f"n{rng.integers(0, 9999)}"
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    df = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").union(docs.select("doc_id", "text"))
    want = brute_components([r for r in df.collect() if r.doc_id is not None])
    got = collected(minhash_dedup.near_duplicates(df))
    assert len(got) == df.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert minhash_dedup.near_duplicates(empty).collect() == []


def test_a_large_group_of_near_copies_is_one_component(spark, monkeypatch):
    """Nodes stay larger than the limit to the last level: stars and strays link them, not all pairs."""
    monkeypatch.setattr(minhash_dedup, "SMALL_NODE", 4)
    base = [f"v{i}" for i in range(120)]
    data = [(i, " ".join([*base[:i], f"n{i}", *base[i + 1:]])) for i in range(90)]
    data += [(500 + i, " ".join([*base[:60], *(f"o{j}" for j in range(60)), f"q{i}"])) for i in range(30)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = brute_components(df.collect())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(df).collect()} == want


def crowd_with_odd_classes(rng):
    """600 versions of a text, and pairs of alike texts of which only one has the crowd's min-hash, and little else, in common."""
    base = [f"v{i}" for i in range(120)]
    versions = [" ".join([*base[:i % 120], f"n{i}", *base[i % 120 + 1:]]) for i in range(600)]

    def last_min_hash(text):
        return minhash_dedup.min_hashes(minhash_dedup.shingle_sets([text.encode()])[0])[-2:]

    mark = last_min_hash(" ".join(base))
    at = next(i for i in range(116) if last_min_hash(" ".join(base[i:i + 5])) == mark)
    pairs = []
    while len(pairs) < 10:
        odd = [f"w{x}" for x in rng.integers(0, 10**9, 100)]
        odd[50:55] = base[at:at + 5]
        if last_min_hash(" ".join(odd)) == mark:
            pairs.append((" ".join(odd), " ".join([*odd[:52], "changed", *odd[53:]])))
    return versions, pairs


def test_a_crowds_odd_classes_keep_their_links(spark):
    versions, pairs = crowd_with_odd_classes(np.random.default_rng(9))
    data = [(i, t) for i, t in enumerate(versions)] + [(1000 + 2 * i + j, t) for i, pair in enumerate(pairs) for j, t in enumerate(pair)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df).collect()}
    assert {got[i] for i in range(600)} == {0}
    assert [(got[1000 + 2 * i], got[1001 + 2 * i]) for i in range(10)] == [(1000 + 2 * i,) * 2 for i in range(10)]


def test_outside_a_core_nothing_alike_is_left(spark):
    """A class like a single version of the crowd meets the crowd by its min-hashes; cores stay out of the trees."""
    versions, _ = crowd_with_odd_classes(np.random.default_rng(9))
    words = versions[7].split()
    single = " ".join([*words[:105], *(f"x{j}" for j in range(12))])
    texts = [t.encode() for t in [*versions, single]]
    data = [(str(i).encode(), bytearray(minhash_dedup.min_hashes(s))) for i, s in enumerate(minhash_dedup.shingle_sets(texts))]
    candidates, crowds = minhash_dedup.find_candidates(spark.createDataFrame(data, "set binary, sig binary"))
    members = {}
    for r in crowds.collect():
        members.setdefault(bytes(r.crowd), set()).add(bytes(r.set))
    assert any(len(m) == 601 for m in members.values()) and candidates.count() == 0


def test_drop_near_duplicates(docs, empty):
    got = minhash_dedup.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    want = brute_components([r for r in docs.collect() if r.doc_id is not None])
    named = Counter(r.doc_id for r in got.collect() if r.doc_id is not None)
    assert named == Counter(i for i, (_, c) in want.items() if i == c)
    assert got.filter("doc_id is null").count() == 2
    assert minhash_dedup.drop_near_duplicates(empty).collect() == []


# --- 10 sharding ---------------------------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 5, 24])
def test_sharding_balances(docs, empty, shards, monkeypatch):
    import zlib

    monkeypatch.setattr(sharding, "BUCKET_ROWS", 4)
    got = sharding.assign_shards(docs, shards).collect()
    counts = Counter(r.shard for r in got)
    per = [counts[s] for s in range(shards)]
    assert sum(per) == docs.count() and max(per) - min(per) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d.doc_id, 8 + len((d.text or "").encode()), zlib.crc32((d.text or "").encode())) for d in docs.collect())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.assign_shards(empty, shards).collect() == []


def test_ring_walk_equals_placing_keys_one_by_one():
    rng = np.random.default_rng(9)
    for shards, vnodes in ((3, 4), (24, 64)):
        demand = {int(p): int(n) for p, n in zip(rng.choice(sharding.POSITIONS, 60, replace=False), rng.integers(1, 40, 60), strict=True)}
        demand[next(iter(demand))] += 700  # a hot key
        points = sharding.ring_points(shards, vnodes)
        n = sum(demand.values())
        got = Counter()
        for p, s, _, rows_, _ in sharding.walk(demand, shards, vnodes):
            got[p, s] += rows_
        home = Counter()
        first = {p: next((i for i, (at, _) in enumerate(points) if at >= p), 0) for p in demand}
        for p, c in demand.items():
            home[points[first[p]][1]] += c
        bound = {s: n // shards for s in range(shards)}
        for s in sorted(range(shards), key=lambda s: (-home[s], s))[: n % shards]:
            bound[s] += 1
        used, want, over = Counter(), Counter(), []
        for p in sorted(demand):
            for _ in range(demand[p]):
                s = points[first[p]][1]
                if used[s] < bound[s]:
                    used[s] += 1
                    want[p, s] += 1
                else:
                    over.append(p)
        for p in over:
            i = first[p]
            while used[points[i % len(points)][1]] >= bound[points[i % len(points)][1]]:
                i += 1
            used[points[i % len(points)][1]] += 1
            want[p, points[i % len(points)][1]] += 1
        assert got == want


def test_write_shards(spark, docs, tmp_dir):
    plain = docs.select("doc_id", "text")
    sharding.write_shards(plain, tmp_dir + "/out", 4)
    back = spark.read.parquet(tmp_dir + "/out")
    assert Counter((r.document.doc_id, r.document.text) for r in back.collect()) == Counter(map(tuple, plain.collect()))


# --- pipeline -------------------------------------------------------------------------------------

@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_empty_tables(spark, docs, empty, labels, tmp_dir, name, stage):
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    for df in (docs, empty):
        out = stage(spark, df, tmp_dir)
        assert name == "packing" or out.dtypes == df.dtypes
        assert out.count() <= 10 * max(1, df.count()) * (df is docs)
