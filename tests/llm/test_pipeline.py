"""The whole pipeline on the smallest tables against a brute-force version, stage by stage."""

import os
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from peerscope.llm import toxicity
from tests.llm.test_cases import brute_components, brute_repeats, words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


class Doc:
    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text


def without_repeated_windows(docs):
    """{doc_id: text} without later three-line windows; texts left without any line go."""
    first, out = {}, {}
    for i in sorted(docs):
        lines = docs[i].split("\n")
        for at in range(len(lines) - 2):
            if "".join(lines[at: at + 3]).strip(" \t\r\x0b\x0c"):
                first.setdefault(tuple(lines[at: at + 3]), (i, at))
    for i, text in docs.items():
        lines = text.split("\n")
        gone = {k for at in range(len(lines) - 2) for k in (at, at + 1, at + 2) if first.get(tuple(lines[at: at + 3]), (i, at)) != (i, at)}
        if len(gone) < len(lines):
            out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_pipeline_equals_brute_force(spark):
    from peerscope.llm.shared import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model, limits = toxicity.train(docs, labels)
    rows = docs.collect()
    score = model.score([toxicity.words_of(r.text, {}) for r in rows])
    want = {r.doc_id: r.text for r, s in zip(rows, score, strict=True) if s < limits.get(r.lang, toxicity.THRESHOLD)}
    frame = docs
    for name, apply in corpus_pipeline.STAGES:
        frame = stage(apply(spark, frame, SF), f"test-{name}")
        if name == "packing":
            break
        assert frame.dtypes == docs.dtypes
        if name == "line_dedup":
            want = without_repeated_windows(want)
        if name == "near_dedup":
            root = brute_components([Doc(i, t) for i, t in want.items()])
            want = {i: t for i, t in want.items() if root[i][1] == i}
        if name == "substring_dedup":
            ids = sorted(want)
            found = brute_repeats([words(want[i]) for i in ids], 35)
            want = {i: (want[i] if not gone else kept) for i, (n, gone, kept) in zip(ids, found, strict=True) if not gone or gone < n}
        got = {r.doc_id: (r.text, r.n_chars) for r in frame.collect()}
        assert got == {i: (t, len(t)) for i, t in want.items()}, name
    pieces = frame.collect()
    assert Counter((p.doc_id, p.start_word, p.n_words) for p in pieces) == Counter(
        (i, a, min(2048, len(words(t)) - a)) for i, t in want.items() for a in range(0, max(1, len(words(t))), 2048))
    bins = {}
    for p in pieces:
        bins.setdefault(p.bin_id, []).append(p)
    assert all(sum(p.n_words for p in b) <= 2048 and max(Counter(p.source for p in b).values()) == 1 for b in bins.values())
    assert np.mean([sum(p.n_words for p in b) for b in bins.values()]) > 0.7 * 2048
