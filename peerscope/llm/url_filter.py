"""URL filters: allow and block rules first, else logistic regression on hashed character n-grams of host and path.

Everything is DataFrame functions.  The model is trained by full-batch gradient descent on a small labelled URL
table, as one higher-order expression over that table's collected feature lists (at most ``MAX_LABELLED`` rows), and
its ``DIMENSIONS`` weights are a constant of the scoring plan.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from peerscope.llm.shared import hidden, let, table

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
DIMENSIONS = 512
GRAM = 4
EPOCHS = 60
RATE = 4.0
DECAY = 0.001
MAX_LABELLED = 10_000

# The default labelled table: (url, 1 = block).  Any DataFrame (url, label) can take its place.
LABELLED = [
    *[(u, 0) for u in (
        "https://docs.example.org/guide/install", "https://en.wiki.example.org/history/bridge", "http://news.example.com/en/politics/2021",
        "https://blog.science.example.com/en/biology", "https://university.example.org/library/catalog", "https://www.museum.example.org/fr/visite",
        "http://recipes.example.com/en/soup.html", "https://forum.example.com/en/garden/tomato", "https://weather.example.org/de/bericht",
        "https://journal.example.org/en/article/1024", "https://code.example.com/en/project/readme", "http://city.example.org/es/noticias",
        "https://m.books.example.com/en/novel/55", "https://www.health.example.org/en/advice", "https://law.example.org/fr/code/12",
        "https://photos.example.com/en/album/7", "https://travel.example.com/en/rome/walks", "https://music.example.org/en/notes")],
    *[(u, 1) for u in (
        "http://casino-bonus.example.com/free-spins", "https://xxx-videos.example.com/hot", "http://cheap-pills.example.com/buy-now",
        "https://win-cash.example.com/jackpot?ref=x", "http://adult-chat.example.com/live-girls", "https://poker.example.com/bonus/free",
        "http://replica-watches.example.com/cheap", "https://payday-loan.example.com/instant-cash", "http://crack-keygen.example.com/download",
        "https://torrent.example.com/free-download/movie", "http://betting.example.com/odds/bonus", "https://spam-offer.example.com/click-here",
        "http://click-track.example.com/redirect?utm_source=ad", "https://lottery.example.com/winner/claim", "http://escort.example.com/girls",
        "https://viagra.example.com/buy-cheap", "http://phish-login.example.com/verify-account", "https://free-gift.example.com/claim-now")],
]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def features(host: Column, path: Column, n: int = GRAM, dimensions: int = DIMENSIONS) -> Column:
    """Buckets (1-based) of the distinct character n-grams of ``^host$`` and ``^path$``."""
    def grams(kind: str, text: Column) -> Column:
        def of(letters: Column) -> Column:
            at = F.sequence(F.lit(0), F.greatest(F.size(letters) - n, F.lit(0)))
            return F.transform(at, lambda i: F.concat(F.lit(kind), *[F.coalesce(F.get(letters, i + k), F.lit("")) for k in range(n)]))

        return let(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), of)

    both = F.array_distinct(F.concat(grams("h", host), grams("p", path)))
    return F.array_distinct(F.transform(both, lambda g: (F.pmod(F.crc32(g.cast("binary")), F.lit(dimensions)) + 1).cast("int")))


def _logit(weights: Column, bias: Column, gram: Column) -> Column:
    total = F.aggregate(gram, F.lit(0.0), lambda s, g: s + F.element_at(weights, g))
    return bias + total / F.sqrt(F.greatest(F.size(gram), F.lit(1)).cast("double"))


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def train(labelled: DataFrame, n: int = GRAM, dimensions: int = DIMENSIONS, epochs: int = EPOCHS,
          limit: int = MAX_LABELLED) -> tuple[list[float], float]:
    """Weights and bias learnt from a small table (url, label); rows with a null label are left out.

    Of a table of more than ``limit`` labelled rows those with the smallest url hashes are learnt.  Without rows all
    weights are 0 (every url scores 0.5).  Labels are taken in url order, so the result is the same for any partitioning.
    """
    rows = labelled.filter(F.col("label").isNotNull()).select(
        F.struct(F.coalesce("url", F.lit("")).alias("url"), F.col("label").cast("double").alias("y"),
                 features(host_of(F.col("url")), path_of(F.col("url")), n, dimensions).alias("x")).alias("r"))
    rows = rows.orderBy(F.xxhash64("r.url"), "r").limit(limit)
    table_ = rows.agg(F.sort_array(F.collect_list("r")).alias("rows"))
    zero = F.array_repeat(F.lit(0.0), dimensions + 1)  # the last place is the bias
    count = F.greatest(F.size("rows"), F.lit(1)).cast("double")

    def epoch(w: Column, _: Column) -> Column:
        # (bucket, push) of every example, summed by bucket through one fold over a dense vector
        push = F.transform("rows", lambda r: F.struct(
            r["x"].alias("x"),
            ((r["y"] - _sigmoid(_logit(w, F.element_at(w, dimensions + 1), r["x"]))) * RATE / count).alias("e"),
            F.sqrt(F.greatest(F.size(r["x"]), F.lit(1)).cast("double")).alias("norm")))
        return F.transform(w, lambda old, i: old * (1 - DECAY) + F.aggregate(
            push, F.lit(0.0), lambda s, p: s + F.when(i == dimensions, p["e"])
            .when(F.array_contains(p["x"], (i + 1).cast("int")), p["e"] / p["norm"]).otherwise(0.0)))

    weights = table_.select(F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), zero, epoch).alias("w")).first()["w"]
    return list(weights[:-1]), weights[-1]


def judge_urls(pages: DataFrame, url: str = "url", rules: list[tuple[str, str]] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (hidden names on a clash).

    Null urls and urls without ``://`` have an empty host and path, fit no rule and get the method's verdict on the
    empty address.  Urls of any length are judged whole.  Repeated rows are judged alike; a score of exactly 0.5 blocks; an empty table gives an empty result; other columns pass through.
    """
    spark = pages.sparkSession
    labelled = labelled if labelled is not None else spark.createDataFrame(LABELLED, "url string, label int")
    weights, bias = train(labelled)
    out = {c: hidden(c, pages.columns) for c in ("host", "path", "rule", "verdict", "score")}
    parts = pages.withColumns({out["host"]: host_of(F.col(url)), out["path"]: path_of(F.col(url))})
    host, path = F.col(out["host"]), F.col(out["path"])
    constant = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    score = _sigmoid(_logit(constant, F.lit(bias), features(host, path)))
    rule, verdict = rule_of(host, path, rules)
    judged = parts.withColumn(out["score"], score)
    return judged.select(
        *[F.col(c) for c in pages.columns], host, path, rule.alias(out["rule"]),
        F.coalesce(verdict, F.when(F.col(out["score"]) >= 0.5, "block").otherwise("allow")).alias(out["verdict"]), out["score"])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
