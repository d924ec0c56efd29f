"""File-stream ingest: availableNow twice, new files only, rejects, same-name rewrite (K1-K4)."""

import os

import pytest

from peerscope.sources import contracts as K
from peerscope.sources.publish import Folders
from peerscope.streaming.file_ingest import ingest_stream, unrecognised_files

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(lines))


def test_ingest_twice_only_new_files(spark, tmp_dir):
    land, raw, ck, q = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck", "q"))
    os.makedirs(land)
    c = K.OLIST["sellers"]
    write(os.path.join(land, "sellers_1.csv"), ["s1,1000,sao paulo,SP\n", "s2,2000,rio,RJ\n"])
    write(os.path.join(land, "notes.txt"), ["ignored\n"])
    r1 = ingest_stream(spark, land, c, raw, ck, q, glob="sellers_*.csv", ingestion_date="2024-01-01")
    assert (r1.rows_written, r1.rows_rejected) == (2, 0)
    # a bad file is rejected as a whole; a good new file lands; the old one is not re-read
    write(os.path.join(land, "sellers_2.csv"), ["s3,3000,bh,MG\n", "s4,notanumber,x,SP\n"])
    write(os.path.join(land, "sellers_3.csv"), ["s5,5000,recife,PE\n"])
    r2 = ingest_stream(spark, land, c, raw, ck, q, glob="sellers_*.csv", ingestion_date="2024-01-01")
    assert (r2.rows_written, r2.rows_rejected) == (1, 2)
    ids = sorted(r.seller_id for r in spark.read.parquet(os.path.join(raw, "olist_sellers")).collect())
    assert ids == ["s1", "s2", "s5"]
    assert spark.read.parquet(os.path.join(q, "sellers")).count() == 2
    # K4: a seen file uploaded again under the same name replaces its own rows
    write(os.path.join(land, "sellers_1.csv"), ["s9,9000,x,SP\n"])
    r3 = ingest_stream(spark, land, c, raw, ck, q, glob="sellers_*.csv")
    assert r3.rows_written == 1
    assert sorted(r.seller_id for r in spark.read.parquet(os.path.join(raw, "olist_sellers")).collect()) == ["s5", "s9"]
    # K2: files with no contract are listed, not read
    unk = [r.file_name for r in unrecognised_files(spark, land, ["sellers.csv"]).collect()]
    assert unk == ["notes.txt"]
    assert r1.low_volume  # below the declared minimum volume: warning (M8)


def test_dispatch_all_tables(spark, tmp_dir):
    from peerscope.streaming.file_ingest import ingest_all_streams, stem_glob

    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    assert stem_glob("olist_orders_dataset.csv") == "olist_orders_dataset*.csv"
    write(os.path.join(land, "olist_sellers_dataset.csv"), ["s1,1000,sao paulo,SP\n"])
    with open(os.path.join(land, "olist_geolocation_dataset.csv"), "w", encoding="utf-8") as f:
        f.write("geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n")
        f.write("1037,-23.5,-46.6,sao paulo,SP\n")
    write(os.path.join(land, "mystery.csv"), ["x,1,y,z\n"])
    reports = ingest_all_streams(spark, land, raw, ck, ingestion_date="2024-01-01")
    assert reports["sellers"].rows_written == 1 and reports["geolocation"].rows_written == 1
    assert reports["orders"].rows_written == 0
    again = ingest_all_streams(spark, land, raw, ck)
    assert sum(r.rows_written for r in again.values()) == 0  # nothing new
    write(os.path.join(land, "olist_sellers_dataset_2.csv"), ["s2,2000,rio,RJ\n"])  # re-upload, new name
    third = ingest_all_streams(spark, land, raw, ck, ingestion_date="2024-01-02")
    assert third["sellers"].rows_written == 1
    geo = spark.read.parquet(os.path.join(raw, "olist_geolocation")).first()
    assert geo.geolocation_zip_code_prefix == 1037  # typed by the contract


def test_new_checkpoint_does_not_overwrite(spark, tmp_dir):
    land, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    os.makedirs(land)
    write(os.path.join(land, "sellers_1.csv"), ["s1,1000,sao paulo,SP\n"])
    c = K.OLIST["sellers"]
    ingest_stream(spark, land, c, raw, os.path.join(tmp_dir, "ck1"), glob="sellers_*.csv", ingestion_date="2024-01-01")
    # K4: reprocessing from a new checkpoint re-reads the folder; batch 0 of the new stream is its own partition
    ingest_stream(spark, land, c, raw, os.path.join(tmp_dir, "ck2"), glob="sellers_*.csv", ingestion_date="2024-01-01")
    assert spark.read.parquet(os.path.join(raw, "olist_sellers")).count() == 2


def test_continuous_stream_picks_up_new_files(spark, tmp_dir):
    from peerscope.streaming.file_ingest import start_ingest_stream

    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    write(os.path.join(land, "sellers_1.csv"), ["s1,1000,sao paulo,SP\n"])
    q, stats = start_ingest_stream(spark, land, K.OLIST["sellers"], raw, ck, glob="sellers_*.csv",
                                   ingestion_date="2024-01-01", processing_time="1 second")
    try:
        q.processAllAvailable()
        write(os.path.join(land, "sellers_2.csv"), ["s2,2000,rio,RJ\n"])  # lands while the stream runs
        q.processAllAvailable()
    finally:
        q.stop()
    assert stats["written"] == 2
    assert spark.read.parquet(os.path.join(raw, "olist_sellers")).count() == 2


def test_rejects_are_kept_without_a_named_quarantine(spark, tmp_dir):
    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    write(os.path.join(land, "sellers_1.csv"), ["s1,1000,sp,SP\n", "s2,notanumber,x,SP\n"])
    r = ingest_stream(spark, land, K.OLIST["sellers"], raw, ck, glob="sellers_*.csv")
    assert (r.rows_in, r.rows_written, r.rows_rejected) == (2, 0, 2)
    assert spark.read.parquet(raw + "_quarantine/sellers").count() == 2


def test_batch_is_dated_by_its_newest_file(spark, tmp_dir):
    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    write(os.path.join(land, "sellers_1.csv"), ["s1,1000,sp,SP\n"])
    os.utime(os.path.join(land, "sellers_1.csv"), (1704110400, 1704110400))  # 2024-01-01 12:00 UTC
    ingest_stream(spark, land, K.OLIST["sellers"], raw, ck, glob="sellers_*.csv")
    assert [str(r.ingestion_date) for r in spark.read.parquet(os.path.join(raw, "olist_sellers")).collect()] == ["2024-01-01"]


def test_columns_are_bound_by_each_files_header(spark, tmp_dir):
    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    for name, text in {"sellers_1.csv": "seller_id,seller_zip_code_prefix,seller_state,seller_city\ns1,1000,SP,sao paulo\n",
                       "sellers_2.csv": HEADER + "s2,2000,rio,RJ\n",
                       "sellers [3]*.csv": "more,seller_city,seller_state,seller_id,seller_zip_code_prefix\nx,\"a, b\",MG,s3,3000\n",
                       "sellers_4.csv": "seller_id,seller_city,seller_state\ns4,x,SP\ns5,y,SP\n",
                       "sellers_5.csv": HEADER.replace("seller_city", "seller_id") + "s6,1,s7,SP\n",
                       "sellers_6.csv": ""}.items():
        with open(os.path.join(land, name), "w", encoding="utf-8") as f:
            f.write(text)
    r = ingest_stream(spark, land, K.OLIST["sellers"], raw, ck, glob="sellers*.csv")
    rows = {x.seller_id: (x.seller_zip_code_prefix, x.seller_city, x.seller_state) for x in spark.read.parquet(os.path.join(raw, "olist_sellers")).collect()}
    assert rows == {"s1": (1000, "sao paulo", "SP"), "s2": (2000, "rio", "RJ"), "s3": (3000, "a, b", "MG")}
    kept = spark.read.parquet(raw + "_quarantine/sellers").collect()
    assert sorted((os.path.basename(x["_file"]), x["_line"]) for x in kept) == [
        ("sellers_4.csv", "s4,x,SP"), ("sellers_4.csv", "s5,y,SP"), ("sellers_4.csv", "seller_id,seller_city,seller_state"),
        ("sellers_5.csv", "s6,1,s7,SP"), ("sellers_5.csv", "seller_id,seller_zip_code_prefix,seller_id,seller_state")]
    assert {x["_reason"] for x in kept if "_4" in x["_file"]} == {"no column seller_zip_code_prefix in the header"}
    assert (r.rows_written, r.rows_rejected) == (3, 5)
    assert ingest_stream(spark, land, K.OLIST["sellers"], raw, ck, glob="sellers*.csv").rows_in == 0


def test_uploads_under_an_old_name(spark, tmp_dir):
    """A rejected new version leaves the old rows, a good one replaces them and only them."""
    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    c, path = K.OLIST["sellers"], os.path.join(land, "sellers_1.csv")

    def run():
        r = ingest_stream(spark, land, c, raw, ck, glob="sellers_*.csv", ingestion_date="2024-01-01")
        return r.rows_written, r.rows_rejected, sorted((x.seller_id, x.seller_city) for x in spark.read.parquet(os.path.join(raw, "olist_sellers")).collect())

    write(path, ["s1,1,a,SP\n", "s2,2,b,SP\n"])
    write(os.path.join(land, "sellers_2.csv"), ["s3,3,c,SP\n"])
    assert run() == (3, 0, [("s1", "a"), ("s2", "b"), ("s3", "c")])
    write(path, ["s1,1,new,SP\n", "s2,two,b,SP\n"])
    assert run() == (0, 2, [("s1", "a"), ("s2", "b"), ("s3", "c")])
    write(path, ["s1,1,new,SP\n"])
    assert run() == (1, 0, [("s1", "new"), ("s3", "c")])
    write(path, ["s1,1,newest,SP\n", "s4,4,d,SP\n"])
    assert run() == (2, 0, [("s1", "newest"), ("s3", "c"), ("s4", "d")])
    assert run() == (0, 0, [("s1", "newest"), ("s3", "c"), ("s4", "d")])


def test_micro_batches_and_a_replay(spark, tmp_dir):
    """Three micro-batches of two files; the last is replayed as if the stream had died before its commit."""
    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    c = K.OLIST["sellers"]
    for i in range(6):
        write(os.path.join(land, f"sellers_{i}.csv"), [f"s{i},{i if i != 4 else 'x'},a,SP\n"])
    r = ingest_stream(spark, land, c, raw, ck, glob="sellers_*.csv", ingestion_date="2024-01-01", max_files=2)
    assert (r.batches, r.rows_written, r.rows_rejected) == (3, 5, 1)
    Folders(spark).delete(os.path.join(ck, "commits", "2"))
    again = ingest_stream(spark, land, c, raw, ck, glob="sellers_*.csv", ingestion_date="2024-01-01", max_files=2)
    assert (again.batches, again.rows_in) == (0, 0)
    assert spark.read.parquet(os.path.join(raw, "olist_sellers")).count() == 5
    assert spark.read.parquet(raw + "_quarantine/sellers").count() == 1


@pytest.mark.parametrize("moves", range(4))
def test_interrupted_publishing_is_completed(spark, tmp_dir, monkeypatch, moves):
    """The stream dies while a micro-batch is published; the next run completes it and lands nothing twice."""
    from peerscope.sources import publish

    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    c, path = K.OLIST["sellers"], os.path.join(land, "sellers_1.csv")
    write(path, ["s1,1,a,SP\n"])
    ingest_stream(spark, land, c, raw, ck, glob="sellers_*.csv", ingestion_date="2024-01-01")
    write(path, ["s1,1,b,SP\n", "s2,2,b,SP\n"])
    move, seen = publish.Folders.move, []

    def dies(self, source, target):
        if publish.JOURNAL not in target:
            if len(seen) == moves:
                raise OSError("lost")
            seen.append(target)
        move(self, source, target)

    monkeypatch.setattr(publish.Folders, "move", dies)
    with pytest.raises(OSError, match="lost"):
        ingest_stream(spark, land, c, raw, ck, glob="sellers_*.csv", ingestion_date="2024-01-01")
    monkeypatch.setattr(publish.Folders, "move", move)
    r = ingest_stream(spark, land, c, raw, ck, glob="sellers_*.csv", ingestion_date="2024-01-01")
    assert r.rows_in == 0 if moves else r.rows_in >= 0
    rows = spark.read.parquet(os.path.join(raw, "olist_sellers")).collect()
    assert sorted((x.seller_id, x.seller_city) for x in rows) == [("s1", "b"), ("s2", "b")]


def test_rejecting_single_rows(spark, tmp_dir):
    land, raw, ck = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "ck"))
    os.makedirs(land)
    write(os.path.join(land, "sellers_1.csv"), ["s1,1000,sp,SP\n", "s2,notanumber,x,SP\n"])
    r = ingest_stream(spark, land, K.OLIST["sellers"], raw, ck, glob="sellers_*.csv", whole_file=False)
    assert (r.rows_in, r.rows_written, r.rows_rejected) == (2, 1, 1)
    assert [x["_reason"] for x in spark.read.parquet(raw + "_quarantine/sellers").collect()] == ["invalid row"]
