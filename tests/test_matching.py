"""Mahalanobis matching against a numpy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscope.operators import matching as MT

FEATS = ["f1", "f2", "f3"]


def make(spark, n=40, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * np.array([1000.0, 1.0, 0.01]) + np.array([5e4, 3.0, 0.5])
    rows = [(i, f"place{i}", "UF", *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, name string, uf string, f1 double, f2 double, f3 double"), x


def brute(x, target, k=5):
    vi = np.linalg.inv(np.cov(x.T))
    d = np.sqrt(np.einsum("ij,jk,ik->i", x - x[target], vi, x - x[target]))
    others = np.delete(np.arange(len(x)), target)
    p10 = np.percentile(d[others], 10)
    order = sorted(others, key=lambda i: (d[i], i))[:k]
    return [(i, d[i], d[i] / p10) for i in order], p10


def test_match_one_equals_numpy(spark):
    df, x = make(spark)
    res = MT.match_one(df, 3, "id", FEATS, k=5, keep=["name"])
    got = [(r.id, r.distancia, r.ratio, r.rank, r.label) for r in res.matches.orderBy("rank").collect()]
    want, p10 = brute(x, 3)
    assert res.p10 == pytest.approx(p10, rel=1e-9)
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1] == pytest.approx(w[1], rel=1e-9) and g[2] == pytest.approx(w[2], rel=1e-9)
    assert [g[3] for g in got] == [1, 2, 3, 4, 5]


def test_distance_properties(spark):
    df, x = make(spark, n=15)
    metric = MT.fit_metric(df, FEATS)
    d_self = df.filter("id = 2").select(metric.distance_to(list(x[2])).alias("d")).first().d
    assert d_self == pytest.approx(0.0, abs=1e-9)
    d_ab = df.filter("id = 5").select(metric.distance_to(list(x[2])).alias("d")).first().d
    d_ba = df.filter("id = 2").select(metric.distance_to(list(x[5])).alias("d")).first().d
    assert d_ab == pytest.approx(d_ba, rel=1e-12)
    dx = x[5] - x[2]
    assert d_ab == pytest.approx(float(np.sqrt(dx @ metric.inverse @ dx)), rel=1e-9)


def test_singular_covariance(spark):
    # 6 complete rows for 6 features -> singular
    rows = [tuple(float(i * j) for j in range(1, 7)) for i in range(6)]
    df = spark.createDataFrame(rows, ",".join(f"g{j} double" for j in range(6)))
    with pytest.raises(MT.SingularCovariance):
        MT.fit_metric(df, [f"g{j}" for j in range(6)])
    const = spark.createDataFrame([(float(i), 1.0) for i in range(20)], "a double, b double")
    with pytest.raises(MT.SingularCovariance):
        MT.fit_metric(const, ["a", "b"])


def test_target_unavailable(spark):
    df, _ = make(spark, n=12)
    df = df.withColumn("f2", F.when(F.col("id") == 4, None).otherwise(F.col("f2")))
    with pytest.raises(MT.TargetUnavailable):
        MT.match_one(df, 4, "id", FEATS)
    req = spark.createDataFrame([(4,), (5,), (99,)], "id int")
    assert sorted(r.id for r in MT.unavailable_targets(req, df, "id", FEATS).collect()) == [4, 99]


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).exponential(size=3000)), [1.0] * 50 + [2.0] * 50, [3.0] * 40, [1.0], [2.0, 1.0],
    [1e-300, 1e300, -1e300, 0.0, 1.0, 1.0 + 2 ** -52], [-5.0, -5.0, 7.0, 7.0, 7.0], [1.7e308, -1.7e308, 0.0], [5e-324, 0.0, 1e-323]])
def test_exact_percentile_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "d double")
    for p in (0.0, 0.1, 0.5, 0.93, 1.0):
        want = float(np.sort(values)[int(p * (len(values) - 1))]) if len(values) == 3 else float(np.percentile(values, p * 100))
        if len(values) == 3 and p not in (0.0, 0.5, 1.0):
            continue  # the interpolated distance overflows in either
        assert MT.exact_percentile(df, "d", p) == pytest.approx(want, rel=1e-12)
    assert MT.exact_percentile(df.filter("d IS NULL"), "d", 0.1) is None


def test_percentile_plan_sorts_nothing(spark):
    import inspect
    assert "Window" not in inspect.getsource(MT.exact_percentile) + inspect.getsource(MT._at_rank)


def test_p10_zero_gives_little_similarity(spark):
    # p10 = 0 -> NULL ratio -> last label
    rows = [(i, 1.0 if i < 8 else float(i), float(i % 3)) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    res = MT.match_one(df, 0, "id", ["a", "b"], k=3)
    labels = [r.label for r in res.matches.collect()]
    assert all(lb in MT.similarity_label.__globals__["SIMILARITY_LABELS"] for lb in labels)


def test_comparison_long_and_result_table(spark):
    df, _ = make(spark, n=12)
    res = MT.match_one(df, 0, "id", FEATS, k=3, keep=["name", "uf"])
    long = MT.comparison_long(res, "id", FEATS, percent_features=["f3"], keep=["name"])
    assert long.count() == 4 * 3
    t = long.filter("role = 'target' and feature = 'f3'").first()
    assert t.value == pytest.approx(df.filter("id = 0").first().f3 * 100)
    tab = MT.result_table(res, "id", "name", "uf").collect()
    assert [r["rank"] for r in tab] == [1, 2, 3]


@pytest.mark.parametrize("kind", ["normal", "few values", "two values", "one value", "mostly one", "with infinities", "tiny and huge"])
def test_percentile_beyond_the_sketch(spark, monkeypatch, kind):
    """More values than a sketch holds: brackets, ties on both sides of a rank, extreme values."""
    monkeypatch.setattr(MT, "SKETCH_SIZE", 64)
    monkeypatch.setattr(MT, "RANK_MARGIN", 0.05)
    rng = np.random.default_rng(3)
    n = 3000
    x = {"normal": rng.normal(size=n), "few values": rng.integers(0, 7, n).astype(float), "two values": np.repeat([1.0, 2.0], n // 2),
         "one value": np.full(n, 5.0), "mostly one": np.where(rng.random(n) < 0.9, 3.0, rng.normal(size=n)),
         "with infinities": np.concatenate((np.full(40, -np.inf), rng.normal(size=n - 80), np.full(40, np.inf))),
         "tiny and huge": np.exp(rng.normal(0, 100, n)) * rng.choice([-1, 1], n)}[kind]
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(x)], "v double").repartition(4)
    for p in (0.0, 0.0003, 0.1, 0.5, 0.77, 0.9999, 1.0):
        ranked = np.sort(x)
        pos = p * (n - 1)
        low, high = ranked[int(pos)], ranked[min(int(pos) + 1, n - 1)]
        want = low if low == high else low + (high - low) * (pos - int(pos))
        assert MT.exact_percentile(df, "v", p) == pytest.approx(want, rel=1e-12)


def test_percentile_takes_two_passes(spark, tmp_dir, monkeypatch):
    import os

    monkeypatch.setattr(MT, "SKETCH_SIZE", 1024)
    path = os.path.join(tmp_dir, "values")
    spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    want = np.percentile([r.v for r in df.collect()], 10)
    store = spark._jsparkSession.sharedState().statusStore()

    def scans():
        found = store.executionsList()
        return sum(path in found.apply(i).physicalPlanDescription() for i in range(found.size()))

    before = scans()
    assert MT.exact_percentile(df, "v", 0.1) == pytest.approx(want, rel=1e-12)
    assert scans() - before == 2
    assert MT.exact_percentile(df.union(spark.createDataFrame([(float("nan"),)], "v double")), "v", 0.1) != want
