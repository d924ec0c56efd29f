"""A corpus pipeline: five stages, each over all documents that its predecessor kept.

toxicity -> line dedup -> near-dedup -> substring dedup -> best-fit packing.  Every stage but the last returns the
columns of ``documents``; ``n_chars`` follows the text.  ``run`` writes each stage as Parquet in the shared folder and
reads it again; what a stage has staged inside is deleted then, its result stays.

In every stage very long texts are taken whole, other columns pass through whatever their names are (but for packing), and
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from peerscope.llm.line_dedup import dedup_lines
from peerscope.llm.minhash_dedup import drop_near_duplicates
from peerscope.llm.packing import pack_documents
from peerscope.llm.shared import stage, stages_dropped, table
from peerscope.llm.substring_dedup import remove_repeats
from peerscope.llm.toxicity import score_documents


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``columns`` with the text taken from ``text``, and the length that goes with it."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return docs.select(*[new.get(c, F.col(c)).alias(c) for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under their language's threshold; one that reaches it goes.

    Null and empty texts have the score of no words.  Rows without an id or with an unknown language are judged too, by the
    common threshold.  Without labels of both kinds all stay.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = score_documents(docs, labels)
    return scored.filter(~F.col(scored.columns[-1])).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of repeated three-line windows; one left without any line goes.

    The first occurrence is that of the smallest id, rows without one come last; rows with equal id and text are one
    document and fare alike.  Null and empty texts and those of fewer than three lines stay as they are.
    """
    done = dedup_lines(docs)
    lines, removed = (F.col(c) for c in done.columns[-2:])
    return _with_text(done.filter((removed == 0) | (removed < lines)), docs.columns, "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; of rows with that id one.

    Rows without an id and those without words, null texts included, are like nothing and stay.
    """
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of words; one that repeats throughout goes, one without repeats is untouched.

    All occurrences of a repeated run go, in repeated rows too.  Null and empty texts and those shorter than a run stay as
    they are.  ``docs`` reads files, as a stage's input does.
    """
    done = remove_repeats(docs, settled=True)
    words, removed, kept = done.columns[-3:]
    done = done.filter((F.col(removed) == 0) | (F.col(removed) < F.col(words)))
    done = done.withColumn(kept, F.when(F.col(removed) == 0, F.col("text")).otherwise(F.col(kept)))
    return _with_text(done, docs.columns, kept)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: doc_id, piece, start_word, n_words, bin_id, bin_offset, source.

    Null and empty texts are pieces of no words; null sources conflict with nothing; repeated rows go into different bins.
    """
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# The first stage's learnt scores have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table ``documents`` in ``sf_dir``; ``labels`` is read there too."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        with stages_dropped():
            docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
