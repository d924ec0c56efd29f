"""From landed files to matched peers through the command line (ingest -> build -> match)."""

import os

import pytest

from peerscope import cli
from peerscope.sources.ingest import InvalidSource, ingest_landing
from tests.fixture_raw import write_landing


def test_ingest_build_match(spark, tmp_dir, capsys, monkeypatch):
    monkeypatch.setattr(cli, "_session", lambda: spark)
    landing, raw, wh = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "wh"))
    write_landing(spark, landing)
    with open(os.path.join(landing, "readme.txt"), "w") as f:
        f.write("not a table")
    assert cli.main(["ingest", "--landing", landing, "--raw", raw, "--date", "2024-02-01"]) == 0
    out = capsys.readouterr().out
    assert "olist_orders: 8 rows  LOW VOLUME" in out and "ibge_censo_9514: 2 rows" in out
    assert sorted(os.listdir(raw)) == sorted([
        "olist_customers", "olist_orders", "olist_order_items", "olist_order_payments", "olist_order_reviews",
        "olist_geolocation", "olist_products", "olist_sellers", "ibge_localidades", "ibge_censo_9514",
        "ibge_censo_10295", "ibge_censo_9936", "bcb_pix"])
    assert cli.main(["build", "--raw", raw, "--warehouse", wh, "--no-volume-tests"]) == 0
    prof = spark.read.parquet(os.path.join(wh, "marts", "mart_geo_analytics"))
    assert prof.count() == 3
    # three places are too few for the >= 10 gate: the match refuses
    from peerscope.operators.filters import NotEnoughRows
    with pytest.raises(NotEnoughRows):
        cli.main(["match", "--warehouse", wh, "--place", "1"])


def test_ingest_is_all_or_nothing(spark, tmp_dir):
    landing, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    write_landing(spark, landing)
    with open(os.path.join(landing, "olist_sellers_dataset.csv"), "a", encoding="utf-8") as f:
        f.write("s9,not-a-zip,x,SP\n")
    with pytest.raises(InvalidSource):
        ingest_landing(spark, landing, raw, "2024-02-01")
    assert not os.path.exists(raw)


def test_match_and_usage_commands(spark, tmp_dir, capsys, monkeypatch):
    from pyspark.sql import functions as F

    from peerscope.plans.benchmark_tables import place_profile_frame, tables, to_double
    monkeypatch.setattr(cli, "_session", lambda: spark)
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("benchmark tables not present")
    wh = os.path.join(tmp_dir, "wh")
    to_double(place_profile_frame(tables(spark, sf))).write.parquet(os.path.join(wh, "marts", "mart_geo_analytics"))
    prof = spark.read.parquet(os.path.join(wh, "marts", "mart_geo_analytics")).dropna(subset=[
        "populacao_residente", "renda_media_per_capita", "pct_domicilios_com_internet", "penetracao_olist",
        "ticket_medio", "transacoes_pix_per_capita"])
    target = prof.agg(F.min("id_municipio")).first()[0]
    assert cli.main(["match", "--warehouse", wh, "--place", str(target), "--compare"]) == 0
    out = capsys.readouterr().out
    assert "rank" in out and "label" in out and "ticket_medio" in out
    everyone = prof.count() - 1
    assert cli.main(["match", "--warehouse", wh, "--place", str(target), "--k", "30"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 1 + min(30, everyone)  # no row is cut from the report
    jobs = os.path.join(tmp_dir, "jobs")
    spark.read.parquet(f"{sf}/events.parquet").select(
        "ts", (F.col("value") * 2 ** 30).alias("bytes"), F.lit("QUERY").alias("job_type"), F.lit("DONE").alias("state")
    ).write.parquet(jobs)
    assert cli.main(["usage", "--jobs", jobs, "--since", "2024-01-20"]) == 0
    assert "jobs" in capsys.readouterr().out
