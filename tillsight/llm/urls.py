"""URL filter by character language models, with DataFrame functions only.

Two variable-order Markov models are counted over URLs that the rules accept and reject.  Their contexts
are the characters as they stand, up to ``ORDER`` of them, in a table that grows with the URLs.  Where
the rules are silent, the difference of the length-normalised log-likelihoods is held against a
threshold that was calibrated on rule-decided URLs that the models did not see.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.shared import materialize
from .common import table

#: Host and path of each rule, and its verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Most characters of context that a character is predicted from.
ORDER = 8
#: A gram that makes up this part of all positions is hot; there are at most so many of them.
HOT = 5_000
#: Log ratios are whole numbers of this part of a nat, so that sums do not depend on their order.
_UNIT = 1_000_000
#: Calibration compares thresholds in steps of this many nats per character.
_STEP = 0.01
#: Of five parts of the rule-decided URLs, one is kept for calibration.
_PARTS = 5


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for NULL or a URL without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def with_rules(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add ``_host, _path, _rule, _ruled``: the longest rule that fits host and path, and its verdict."""
    host, path = url_parts(F.col(url))
    parted = pages.withColumns({"_host": host, "_path": path})
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("_host") == h) | F.col("_host").endswith("." + h)) & F.col("_path").startswith(p)
        rule, ruled = F.when(fits, h + p).otherwise(rule), F.when(fits, verdict).otherwise(ruled)
    return parted.withColumns({"_rule": rule, "_ruled": ruled})


def grams_at(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``_id, _side, _gram`` of every character of each URL: the character after as many as ``order`` before it.

    Characters are code points as they stand.  A gram of fewer than ``order + 1`` characters begins where the URL
    does: so its length tells how many places of its context lie before the start.
    """
    chars = F.split("_url", "")
    size = F.size("_chars")
    gram = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.array_join(
            F.slice("_chars", F.greatest(i - F.lit(order), F.lit(1)), F.least(i, F.lit(order + 1))), ""
        ),
    )
    return urls.withColumn("_chars", chars).select("_id", "_side", F.explode(F.when(size > 0, gram)).alias("_gram"))


def context_ratios(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``(_gram, _all, _ratio)`` of every gram: its occurrences, and the log of accepted over rejected.

    A character is predicted from ``order`` characters before it, which are interpolated with one less, and so on
    down to none and the uniform distribution over the characters of both models and one for all others.  Weights
    follow the rule of Witten and Bell, as in ``log_ratios``.  The table has a row for every gram that occurs, so it
    grows with the URLs; each join meets a row of the shorter context with one row a character at most.
    """
    counted = materialize(
        grams.groupBy("_gram").agg(
            F.count(F.lit(1)).alias("_all"),
            F.count_if(F.col("_side") == "allow").alias("_allow"),
            F.count_if(F.col("_side") == "block").alias("_block"),
        )
    )
    levels = F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("_level")
    ends = (
        counted.select("*", levels)
        .groupBy("_level", F.right("_gram", F.col("_level")).alias("_end"))
        .agg(F.sum("_allow").alias("_allow"), F.sum("_block").alias("_block"))
        .withColumn("_context", F.left("_end", F.char_length("_end") - 1))
    )
    # a context has one row for each character at most
    context = Window.partitionBy("_level", "_context")

    def weights(side: str) -> list[Column]:
        """What the own counts add, and the weight of the shorter context."""
        n = F.col(side)
        s, t = F.sum(n).over(context).cast("double"), F.count_if(n > 0).over(context).cast("double")
        return [
            F.when(s > 0, n / (s + t)).otherwise(0.0).alias(f"{side}_own"),
            F.when(s > 0, t / (s + t)).otherwise(1.0).alias(f"{side}_rest"),
        ]

    weighed = materialize(ends.select("_level", "_end", *weights("_allow"), *weights("_block"), (F.col("_allow") + F.col("_block") > 0).alias("_known")))
    letters = weighed.where("_level = 1 and _known").count()
    sides = ("_allow", "_block")
    at = weighed.where("_level = 1").select(
        "_end", *[(F.col(f"{x}_own") + F.col(f"{x}_rest") * F.lit(1.0 / (letters + 1))).alias(x) for x in sides]
    )
    for k in range(2, order + 2):
        below = at.toDF("_below", "_allow", "_block")
        at = (
            weighed.where(F.col("_level") == k)
            .join(below, F.right("_end", F.lit(k - 1)) == F.col("_below"))
            .select("_end", *[(F.col(f"{x}_own") + F.col(f"{x}_rest") * F.col(x)).alias(x) for x in sides])
        )
    ratio = F.round((F.log("_allow") - F.log("_block")) * _UNIT).cast("long")
    return counted.select("_gram", "_all").join(at, F.col("_gram") == F.col("_end")).select("_gram", "_all", ratio.alias("_ratio"))


def _scores(grams: DataFrame, ratios: DataFrame) -> DataFrame:
    """``_id, _score``: log-likelihood difference per character of each URL.

    The table of ratios grows with the URLs and is joined by shuffle.  Grams that many URLs share, as those of
    their first characters, would make large tasks: those that take ``1 / HOT`` of all positions or more are
    joined by broadcast instead, of which there are at most ``HOT``.
    """
    total = ratios.agg(F.sum("_all")).first()[0] or 0
    hot = F.broadcast(ratios.where(F.col("_all") * HOT >= total).select("_gram", "_ratio"))
    many = grams.select("_id", "_gram").join(hot, "_gram").select("_id", "_ratio")
    few = (
        grams.select("_id", "_gram")
        .join(hot.select("_gram"), "_gram", "left_anti")
        .join(ratios.where(F.col("_all") * HOT < total).select("_gram", "_ratio"), "_gram")
        .select("_id", "_ratio")
    )
    return (
        many.union(few)
        .groupBy("_id")
        .agg((F.sum("_ratio") / (F.count(F.lit(1)) * F.lit(float(_UNIT)))).alias("_score"))
    )


def _threshold(scored: DataFrame) -> DataFrame:
    """One row: the threshold with the best sum of accepted and rejected shares, the lowest of ties.

    Scores are counted in steps first, so the window runs over a bounded number of rows: a score lies
    between the logs of the least and the largest possible ratio.
    """
    steps = scored.groupBy(F.floor(F.col("_score") / _STEP).alias("_step")).agg(
        F.count_if(F.col("_ruled") == "allow").alias("_good"), F.count_if(F.col("_ruled") == "block").alias("_bad")
    )
    below = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    good_below = F.coalesce(F.sum("_good").over(below), F.lit(0))
    bad_below = F.coalesce(F.sum("_bad").over(below), F.lit(0))
    all_good, all_bad = F.sum("_good").over(every), F.sum("_bad").over(every)
    gain = bad_below * all_good - good_below * all_bad
    best = steps.withColumns({"_gain": gain, "_both": all_good * all_bad}).where("_both > 0")
    return best.agg(
        F.coalesce(
            F.min_by(F.col("_step"), F.struct(-F.col("_gain"), F.col("_step"))).cast("double") * F.lit(_STEP), F.lit(0.0)
        ).alias("_limit")
    )


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """The pages with ``_host, _path, _rule, _verdict``.

    Models and scores are made of distinct URLs, so a URL that fills a third of the table counts
    once, and only the join of the verdicts, which adaptive execution can split, sees it again.
    A NULL or empty URL has score 0; other URLs are judged whole, whatever their length.
    Without rule-decided URLs of both kinds the threshold is 0.
    """
    ruled = with_rules(pages, url, rules)
    distinct = materialize(
        ruled.where(F.col(url) != "")
        .select(F.col(url).alias("_url"), "_ruled")
        .distinct()
        .withColumn("_id", F.monotonically_increasing_id())
    )
    fold = F.pmod(F.crc32(F.col("_url").cast("binary")), F.lit(_PARTS)) == 0
    grams = materialize(grams_at(distinct.withColumn("_side", F.when(~fold, F.col("_ruled")))))
    ratios = materialize(context_ratios(grams))
    scored = materialize(distinct.join(_scores(grams, ratios), "_id").select("_url", "_ruled", "_score"))
    kept = scored.where(F.col("_ruled").isNotNull() & fold)
    limit = F.coalesce(F.lit(_threshold(kept).first()[0]), F.lit(0.0))
    verdicts = scored.select(F.col("_url").alias("_of"), "_score")
    open_pages = ruled.join(verdicts, F.col(url) == F.col("_of"), "left")
    by_model = F.when(F.coalesce(F.col("_score"), F.lit(0.0)) >= limit, "allow").otherwise("block")
    return open_pages.withColumn("_verdict", F.coalesce("_ruled", by_model)).drop("_of", "_ruled")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"),
    )
