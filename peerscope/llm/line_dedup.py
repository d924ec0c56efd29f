"""Line dedup on overlapping three-line windows, in DataFrame functions only.

A window is three consecutive lines of one text (lines end at a line feed).  The windows of all texts are hashed
and the repeated ones found globally; every occurrence but the first (smallest doc_id, then text hash, then
position) is covered, and the lines of all covered windows are removed.  Windows of three blank lines never count.

Only hashes travel: one row a line.  The first place of each window is pre-aggregated on the map side, and the
repeated windows meet their occurrences on (window, salt), so a window that a third of all texts share is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from peerscope.llm.shared import hidden, let, table

WIDTH = 3
SALTS = 16


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def covered_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc, body, covered): for each document with removals, its id, text hash and 0-based lines to remove."""
    lines = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("body"), _lines(F.col(text)).alias("line"))
    lines = lines.filter(F.size("line") >= width)
    # 128 bits a line, so that equal hashes mean equal lines at any size of corpus
    lines = lines.select("doc", "body", F.transform("line", lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
        (F.length(F.trim(F.translate(x, "\t\r\u000b\f", "    "))) > 0).alias("ink"))).alias("line"))

    def window(line: Column, i: Column) -> Column:
        part = [F.get(line, i + k) for k in range(width)]
        ink = part[0]["ink"]
        for p in part[1:]:
            ink = ink | p["ink"]
        return F.when(ink, F.struct(F.xxhash64(*[p["a"] for p in part]).alias("a"),
                                    F.xxhash64(*[p["b"] for p in part]).alias("b"), i.alias("at")))

    at = F.sequence(F.lit(0), F.size("line") - F.lit(width))
    windows = let(F.col("line"), lambda line: F.transform(at, lambda i: window(line, i)))
    seen = lines.select("doc", "body", F.explode(windows).alias("w")) \
        .filter(F.col("w").isNotNull()).select("doc", "body", "w.a", "w.b", "w.at")
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "body", "at")
    repeated = seen.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").select("a", "b", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    later = (
        seen.withColumn("salt", F.pmod(F.xxhash64("doc", "body"), F.lit(SALTS)).cast("int"))
        .join(repeated, ["a", "b", "salt"])
        .filter(~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("body") == F.col("first.body"))
                  & (F.col("at") == F.col("first.at"))))
    )
    spans = later.groupBy("doc", "body").agg(F.collect_set("at").alias("at"))
    each = F.flatten(F.transform("at", lambda i: F.sequence(i, i + (width - 1))))
    return spans.select("doc", "body", F.array_distinct(each).alias("covered"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with ``text`` reduced to the kept lines, plus ``n_lines`` and ``n_removed`` (hidden names on a clash).

    Null text has no lines and stays null; an empty text is one empty line.  Texts of fewer than three lines and
    texts without removals stay as they are.  Rows with equal id and text are one document here: all get the same
    result.  Rows with a null id take part and come last in the order.  Texts of any length are taken whole.  An empty
    table gives an empty result; other columns pass through.
    """
    out = {n: hidden(n, docs.columns) for n in ("n_lines", "n_removed", "doc", "body", "covered")}
    covered = covered_lines(docs, doc_id, text, width).select(*[F.col(c).alias(out[c]) for c in ("doc", "body", "covered")])
    lines = F.when(F.col(text).isNull(), F.array().cast("array<string>")).otherwise(_lines(F.col(text)))
    on = F.col(doc_id).eqNullSafe(F.col(out["doc"])) & (F.xxhash64(text) == F.col(out["body"]))

    def left(every: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(out["covered"]))
        return F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n")

    new = let(lines, left)
    removed = F.coalesce(F.size(F.col(out["covered"])), F.lit(0))
    joined = docs.join(covered, on, "left")
    return joined.select(
        *[F.when(F.col(out["covered"]).isNull(), F.col(text)).otherwise(new).alias(c) if c == text else F.col(c)
          for c in docs.columns],
        F.size(lines).cast("long").alias(out["n_lines"]),
        F.when(F.col(out["covered"]).isNull(), F.lit(0)).otherwise(removed).cast("long").alias(out["n_removed"]))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (hex of the kept text) of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, md5(text) AS body, text, string_split(text, chr(10)) AS line FROM documents WHERE text IS NOT NULL
), place AS (
  SELECT DISTINCT doc_id, body, line, unnest(range(len(line) - 2)) AS pos FROM lines
), win AS (
  SELECT doc_id, body, pos, line[pos + 1] || chr(10) || line[pos + 2] || chr(10) || line[pos + 3] AS w FROM place
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS LAST, body, pos) AS nth
  FROM win WHERE regexp_matches(w, '[^\x09-\x0D ]')
), covered AS (
  SELECT DISTINCT doc_id, body, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE nth > 1
), every_line AS (
  SELECT doc_id, body, text, unnest(range(len(line))) AS pos, unnest(line) AS line
  FROM (SELECT DISTINCT doc_id, body, text, line FROM lines)
), kept AS (
  SELECT e.doc_id, e.body, count(*) AS n_lines, count(c.pos) AS n_removed,
         coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE c.pos IS NULL), '') AS kept
  FROM every_line e LEFT JOIN covered c
    ON c.doc_id IS NOT DISTINCT FROM e.doc_id AND c.body = e.body AND c.pos = e.pos
  GROUP BY e.doc_id, e.body
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM d.doc_id AND k.body = md5(d.text)
"""
