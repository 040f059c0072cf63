"""URL filter: host and path rules first, then two character language models.

The models are learnt from the urls that a rule allows and from those that a rule blocks. Each predicts a
character from the five before it, or from as many of these as it has seen in a row, and smooths what a context says
with the next shorter one (Witten-Bell). A url's score is the mean over its characters of the difference of
log-probabilities. The threshold is the one that best separates the two kinds of labelled urls that were held back from
the models. What is counted are the runs of characters that occur, so the model grows with the urls. Everything is
made of native expressions, aggregates and joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import lower_ascii, unused
from tidemark.session import staged

ORDER = 5  # characters of the longest context
START = "\x02"  # stands before the first character
HELD_BACK = "0123"  # first digits of the MD5 of urls that are held back: a quarter
UNIT = 1000  # log-probabilities are kept in steps of 1/UNIT
# Scores are compared in steps of 1/STEPS, within +-LIMIT.
STEPS, LIMIT = 100, 20
KINDS = ("allow", "block")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    path = F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), path).otherwise("")


def _rest(url: Column) -> Column:
    """What follows the first ``://``."""
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def with_rule(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``ruled`` (verdict of the longest rule that fits, or null)."""
    found = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        host = (F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))
        fits = host & F.startswith("path", F.lit(r.path))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return found.withColumns({"rule": rule, "ruled": verdict})


def held_back(text: Column) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, 1).isin(*HELD_BACK)


def runs(text: Column, order: int = ORDER) -> Column:
    """For each character of a text, it and the ``order`` before it."""
    padded = F.concat(F.lit(START * order), text)
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, order + 1))


def distinct_urls(ruled: DataFrame, url: str) -> DataFrame:
    """``id, text, ruled, n``: urls in lower case that are not empty, numbered, and how often each is there."""
    text = lower_ascii(F.col(url))
    found = ruled.where(F.col(url) != "").groupBy(text.alias("text"), "ruled").agg(F.count(F.lit(1)).alias("n"))
    return staged(found.withColumn("id", F.monotonically_increasing_id()), "urls")


def counted(labelled: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """The model: ``run, allow, block`` for every run of up to ``order`` + 1 characters, and the same for contexts.

    Of a context, ``<kind>_n`` is how often it occurs before a character, ``<kind>_kinds`` before how many different ones, and
    ``all_kinds`` that in both kinds together. Only the longest runs are counted in the urls; the shorter ones are sums of
    these. Equal runs of a task are added up before a shuffle, so one that all urls have is no burden.
    """
    longest = labelled.select("ruled", "n", F.explode(runs(F.col("text"), order)).alias("run")).groupBy("run")
    sums = [F.coalesce(F.sum(F.when(F.col("ruled") == k, F.col("n"))), F.lit(0)).alias(k) for k in KINDS]
    longest = staged(longest.agg(*sums), "longest-runs")
    ends = F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda k: F.substring("run", order + 2 - k, k))
    shorter = longest.select(F.explode(ends).alias("run"), *KINDS).groupBy("run")
    every = staged(shorter.agg(*[F.sum(k).alias(k) for k in KINDS]), "runs")
    totals = [e for k in KINDS for e in (F.sum(k).alias(f"{k}_n"), F.count_if(F.col(k) > 0).alias(f"{k}_kinds"))]
    context = F.expr("substring(run, 1, length(run) - 1)").alias("context")
    return every, staged(every.groupBy(context).agg(*totals, F.count(F.lit(1)).alias("all_kinds")), "contexts")


def differences(asked: DataFrame, every: DataFrame, contexts: DataFrame, order: int = ORDER) -> DataFrame:
    """``run, d`` of the asked runs: the last character's log-probability under allowed urls minus that under blocked ones.

    In whole steps of 1/UNIT. A context that a kind has never seen leaves it to the next shorter one; without any, a
    character's share counts, one being added to each.
    """
    end = F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("size")
    ends = asked.select("run", end).withColumn("end", F.substring("run", F.lit(order + 2) - F.col("size"), F.col("size")))
    ends = ends.withColumn("context", F.expr("substring(end, 1, size - 1)"))
    joined = ends.join(every.withColumnRenamed("run", "end"), "end", "left").join(contexts, "context", "left")
    figures = [*KINDS, *[f"{k}_{x}" for k in KINDS for x in ("n", "kinds")], "all_kinds"]
    by_size = [F.coalesce(F.max(F.when(F.col("size") == k, F.col(c))), F.lit(0)).alias(f"{c}_{k}") for k in range(1, order + 2) for c in figures]
    found = joined.groupBy("run").agg(*by_size)
    for kind in KINDS:
        found = found.withColumn(kind, (F.col(f"{kind}_1") + 1) / (F.col(f"{kind}_n_1") + F.col("all_kinds_1") + 1))
        for k in range(2, order + 2):
            n, types = F.col(f"{kind}_n_{k}"), F.col(f"{kind}_kinds_{k}")
            found = found.withColumn(kind, F.when(n > 0, (F.col(f"{kind}_{k}") + types * F.col(kind)) / (n + types)).otherwise(F.col(kind)))
    return found.select("run", F.rint((F.ln("allow") - F.ln("block")) * UNIT).cast("int").alias("d"))


def scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``text, ruled, n, score`` of the urls of :func:`distinct_urls` that no rule decides and of those held back.

    Runs are joined with their differences; a run that very many urls have is split by the adaptive join.
    """
    held = held_back(F.col("text"))
    asked = urls.where(F.col("ruled").isNull() | held)
    every, contexts = counted(urls.where(F.col("ruled").isNotNull() & ~held), order)
    listed = asked.select("id", F.explode(runs(F.col("text"), order)).alias("run"))
    found = staged(differences(listed.select("run").distinct(), every, contexts, order), "differences")
    sums = listed.join(found, "run").groupBy("id").agg(F.sum("d").alias("total"))
    scored = asked.join(sums, "id").withColumn("score", F.col("total") / UNIT / F.length("text"))
    return staged(scored.select("text", "ruled", "n", "score"), "url-scores")


def step_of(score: Column) -> Column:
    return F.floor(F.least(F.greatest(score, F.lit(-LIMIT)), F.lit(LIMIT)) * STEPS).cast("int")


def calibrated(scored: DataFrame) -> DataFrame:
    """One row, ``least``: the lowest step of score that is allowed.

    It makes the sum of the shares of allowed urls below it and of blocked urls from it smallest, and lies in the
    middle of the gap where it does; of several, the lowest. Null without urls of both kinds. The window is over the steps, 4001 at most.
    """
    steps = scored.where(F.col("ruled").isNotNull()).groupBy(step_of(F.col("score")).alias("step"))
    counts = steps.agg(*[F.coalesce(F.sum(F.when(F.col("ruled") == k, F.col("n"))), F.lit(0)).alias(k) for k in KINDS])
    below, every = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    kept_out = F.try_divide(F.coalesce(F.sum("allow").over(below), F.lit(0)), F.sum("allow").over(every))
    let_in = 1 - F.try_divide(F.coalesce(F.sum("block").over(below), F.lit(0)), F.sum("block").over(every))
    cut = F.ceil((F.col("step") + F.coalesce(F.lag("step").over(Window.orderBy("step")), F.col("step"))) / 2)
    errors = counts.select(cut.cast("int").alias("cut"), F.round(kept_out + let_in, 9).alias("error"))
    return errors.agg(F.min(F.when(F.col("error").isNotNull(), F.struct("error", "cut")))["cut"].alias("least"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", order: int = ORDER) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``score`` and ``verdict`` to every row.

    The verdict is that of the longest rule that fits; else ``allow`` if the score reaches the calibrated
    threshold, ``block`` if not. Where no url or no held-back url is allowed, or none is blocked, there is nothing to learn
    from and urls without a rule are allowed. ``score`` is null where a rule decides; that of an empty or null url is 0. A
    null url has an empty host and path. Very long urls are read whole. Columns of these names in ``pages`` are
    replaced, rows that repeat an id have a row each, an empty table gives no rows.
    """
    ruled = with_rule(pages, rules, url)
    scored = scores(distinct_urls(ruled, url), order)
    least = staged(calibrated(scored), "url-threshold").scalar()
    text, known = unused(ruled.columns, "text", "known")
    judged = scored.where(F.col("ruled").isNull()).select(F.col("text").alias(text), F.col("score").alias(known))
    ruled = ruled.withColumn(known + "_text", F.when(F.col("ruled").isNull(), lower_ascii(F.col(url))))
    joined = ruled.join(judged, F.col(known + "_text") == F.col(text), "left").drop("score")
    score = F.when(F.col("ruled").isNull(), F.coalesce(known, F.lit(0.0)))
    learnt = F.when(step_of(score) < least, "block").otherwise("allow")
    joined = joined.withColumns({"verdict": F.coalesce("ruled", learnt), "score": score})
    return joined.drop("ruled", text, known, known + "_text")
