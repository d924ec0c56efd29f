"""Command line: ingest, build, match, usage.

    python -m peerscope.cli ingest --landing DIR --raw DIR [--date YYYY-MM-DD] [--sample-rows N]
    python -m peerscope.cli stream --landing DIR --raw DIR --checkpoint DIR [--every "1 minute"]
    python -m peerscope.cli build  --raw DIR --warehouse DIR [--no-volume-tests]
    python -m peerscope.cli match  --warehouse DIR --place ID [--k 5] [--uf SP ...] [--band ...] [--compare]
    python -m peerscope.cli usage  --jobs PATH --since YYYY-MM-DD [--ts-col ts] [--bytes-col bytes]

Each command is one Spark application; results are tables (written) or a
small printed table (the top-k match, the newest days of usage).
"""

from __future__ import annotations

import argparse
import sys


_PROFILE = {"name": "local"}


def _session():
    from peerscope.session import get_session

    return get_session(profile=_PROFILE["name"])


def cmd_ingest(a) -> int:
    from peerscope.sources.ingest import ingest_landing

    for r in ingest_landing(_session(), a.landing, a.raw, a.date, a.sample_rows):
        flag = "  LOW VOLUME" if r.low_volume else ""
        left_out = f", {r.discarded} discarded" if r.discarded else ""
        print(f"{r.source}: {r.rows} rows{left_out}{flag}")
    return 0


def cmd_stream(a) -> int:
    """Keep one file stream per business table running until interrupted.

    Between two looks at the streams, files uploaded again under their old names are landed.
    """
    from peerscope.sources.contracts import OLIST
    from peerscope.streaming.file_ingest import ingest_changed, start_ingest_stream, stem_glob

    spark = _session()
    tables = [(c, f"{a.checkpoint.rstrip('/')}/{c.name}", stem_glob(c.file_name)) for c in OLIST.values()]
    queries = [start_ingest_stream(spark, a.landing, c, a.raw, checkpoint, a.quarantine, glob=glob, processing_time=a.every)[0]
               for c, checkpoint, glob in tables]
    try:
        while not spark.streams.awaitAnyTermination(a.again):
            for c, checkpoint, glob in tables:
                ingest_changed(spark, a.landing, c, a.raw, checkpoint, a.quarantine, glob=glob)
    finally:
        for q in queries:
            q.stop()
    return 0


def cmd_build(a) -> int:
    from peerscope.plans.layers import LayeredBuild
    from peerscope.sources.contracts import RAW_SOURCES, SNAPSHOT_SOURCES
    from peerscope.sources.publish import finish_publishing
    from peerscope.sources.readers import SourceRegistry

    spark = _session()
    finish_publishing(spark, a.raw)
    registry = SourceRegistry(spark, a.raw, a.min_share)
    raw = registry.register(RAW_SOURCES, SNAPSHOT_SOURCES)
    for source, choice in registry.chosen.items():
        for value, reason in choice.passed_over:
            print(f"warn {source}: snapshot {value} passed over ({reason}), {choice.value} taken")
    b = LayeredBuild(spark, enforce=True, enforce_volume=not a.no_volume_tests, materialize_layers=True,
                     warehouse=a.warehouse)
    b.run(raw, profile_year=a.year)
    for name, warns in b.warnings.items():
        if warns:
            print(f"warn {name}: {warns}")
    c = b.order_coverage().first()
    print(f"geocoded orders: {c.matched} of {c.total}")
    print(f"built {len(b.models)} models")
    return 0


def cmd_match(a) -> int:
    from peerscope.operators.filters import facet_filter
    from peerscope.operators.matching import comparison_long, match_one, result_table

    spark = _session()
    prof = spark.read.parquet(f"{a.warehouse.rstrip('/')}/marts/mart_geo_analytics")
    sel = facet_filter(prof, {"uf_sigla": a.uf or [], "macroregiao_nome": a.region or [],
                              "categoria_populacao": a.band or [], "categoria_olist": a.presence or []})
    res = match_one(sel, a.place, "id_municipio", k=a.k, keep=["nome_municipio", "uf_sigla"])
    print_all(result_table(res, "id_municipio", "nome_municipio", "uf_sigla"))
    if a.compare:
        print_all(comparison_long(res, "id_municipio", keep=["nome_municipio", "uf_sigla"]).orderBy("feature", "rank"))
    return 0


def print_all(df) -> None:
    """Every row, tab-separated under a header (reports are as long as the caller asked for)."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def cmd_usage(a) -> int:
    from peerscope.operators.aggregates import daily_rollup

    spark = _session()
    jobs = spark.read.parquet(a.jobs)
    print_all(daily_rollup(jobs, a.ts_col, a.bytes_col, a.since, type_col=a.type_col, state_col=a.state_col))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="peerscope")
    p.add_argument("--cluster", action="store_true", help="cluster session profile (run under spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landing", required=True)
    i.add_argument("--raw", required=True)
    i.add_argument("--date")
    i.add_argument("--sample-rows", type=int)
    st = sub.add_parser("stream")
    st.add_argument("--landing", required=True)
    st.add_argument("--raw", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--quarantine")
    st.add_argument("--every", default="1 minute")
    st.add_argument("--again", type=float, default=600.0, help="seconds between two searches for files uploaded again")
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--year", type=int, default=2018)
    b.add_argument("--no-volume-tests", action="store_true")
    b.add_argument("--min-share", type=float, default=0.0, help="a newest snapshot below this share of the one before is passed over")
    m = sub.add_parser("match")
    m.add_argument("--warehouse", required=True)
    m.add_argument("--place", type=int, required=True)
    m.add_argument("--k", type=int, default=5)
    m.add_argument("--uf", nargs="*")
    m.add_argument("--region", nargs="*")
    m.add_argument("--band", nargs="*")
    m.add_argument("--presence", nargs="*")
    m.add_argument("--compare", action="store_true", help="also print target vs matches per feature")
    u = sub.add_parser("usage")
    u.add_argument("--jobs", required=True)
    u.add_argument("--since", required=True)
    u.add_argument("--ts-col", default="ts")
    u.add_argument("--bytes-col", default="bytes")
    u.add_argument("--type-col", default="job_type")
    u.add_argument("--state-col", default="state")
    a = p.parse_args(argv)
    _PROFILE["name"] = "cluster" if a.cluster else "local"
    return {"ingest": cmd_ingest, "stream": cmd_stream, "build": cmd_build, "match": cmd_match,
            "usage": cmd_usage}[a.cmd](a)


if __name__ == "__main__":
    sys.exit(main())
