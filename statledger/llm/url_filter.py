"""URL filter: rules by host and path, and for the rest a character language-model ratio.

Two smoothed variable-order Markov models are learnt, from accepted and from rejected URLs. A URL's score is the
difference of their log-likelihoods per character. The threshold is calibrated on judged URLs that the models did not
learn from, a fixed share by the URL's digest. DataFrame functions only. The models are tables over distinct character n-grams, whose number does not follow that of URLs;
n-grams are counted in each task before they are shuffled. Counts and scores are written to the shared folder, as each is
needed more than once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.llm.cluster import written

# Before the first character of a URL; no URL has it.
START = "\u0002"
#: Characters of context of the longest order.
CONTEXT = 3
#: First digits of the MD5 of judged URLs that are held out of the models, for the threshold: 3 of 16.
HELD_OUT = "012"
#: Size of the alphabet that the lowest order is smoothed with.
ALPHABET = 256


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains, for paths that begin with its own."""

    host: str
    path: str
    action: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Lower-cased (A-Z) host and the path of a URL; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def first_rule(rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits columns host and path."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        out = F.when(fits, F.lit(value(rule))) if out is None else out.when(fits, F.lit(value(rule)))
    return F.lit(None).cast("string") if out is None else out


def grams(urls: DataFrame) -> DataFrame:
    """Each character of column subject with the ``CONTEXT`` characters before it, as column gram."""
    padded = F.concat(F.lit(START * CONTEXT), "subject")
    at = F.sequence(F.lit(1), F.length("subject"))
    each = F.transform(at, lambda i: F.substring(padded, i, F.lit(CONTEXT + 1)))
    return urls.filter(F.length("subject") > 0).withColumn("gram", F.explode(each)).drop("subject")


def log_ratios(counts: DataFrame) -> DataFrame:
    """For each gram with its counts in accepted and rejected URLs (a, r): the log ratio of its last character's chances.

    Each order is smoothed with the next lower one after Witten and Bell: a context that was followed n times by t
    different characters gives weight t / (n + t) to the lower order.
    """
    out = counts
    chance = {"a": F.lit(1.0 / ALPHABET), "r": F.lit(1.0 / ALPHABET)}
    for order in range(CONTEXT + 1):
        context, seen = F.substring(F.col("gram"), CONTEXT + 1 - order, order), F.substring(F.col("gram"), CONTEXT + 1 - order, order + 1)
        tails = counts.groupBy(seen.alias(f"seen{order}")).agg(F.sum("a").alias(f"a{order}"), F.sum("r").alias(f"r{order}"))
        heads = tails.groupBy(F.substring(F.col(f"seen{order}"), 1, order).alias(f"context{order}")).agg(
            *[F.sum(f"{c}{order}").alias(f"n{c}{order}") for c in "ar"],
            *[F.count(F.when(F.col(f"{c}{order}") > 0, 1)).alias(f"t{c}{order}") for c in "ar"],
        )
        out = out.join(tails, seen == F.col(f"seen{order}")).join(heads, context == F.col(f"context{order}"))
        for c in "ar":
            # A context that was never followed leaves the lower order's chance as it is.
            n, t, k = F.col(f"n{c}{order}"), F.greatest(F.col(f"t{c}{order}"), F.lit(1)), F.col(f"{c}{order}")
            chance[c] = (k + t * chance[c]) / (n + t)
    return out.select("gram", (F.log(chance["a"]) - F.log(chance["r"])).alias("log_ratio"))


def score_urls(judged: DataFrame, held_out: Sequence[str] = ()) -> DataFrame:
    """Distinct url of ``judged`` with action, held and score, the log ratio per character; none for empty subjects.

    ``judged`` has url, host, path, action (allow, block or null). URLs whose MD5 begins with a digit of ``held_out`` are
    held, and teach nothing.
    """
    subject = F.concat("host", "path")
    urls = judged.filter("url is not null").select("url", "action", subject.alias("subject")).dropDuplicates(["url"])
    each = grams(urls.withColumn("held", F.substring(F.md5("url"), 1, 1).isin(*held_out) if held_out else F.lit(False)))
    taught = F.when(~F.col("held"), F.col("action"))
    counts = each.groupBy("gram").agg(
        F.count(F.when(taught == "allow", 1)).alias("a"), F.count(F.when(taught == "block", 1)).alias("r")
    )
    per_url = each.join(log_ratios(written(counts, "url-grams")), "gram").groupBy("url").agg(
        F.first("action").alias("action"), F.first("held").alias("held"), F.avg("log_ratio").alias("score")
    )
    return per_url


def threshold(scores: DataFrame) -> float:
    """The score as far from the accepted URLs' mean as from the rejected ones', in standard deviations.

    Only held URLs count. Without such URLs of one kind there is no telling: minus infinity, so that everything is accepted.
    """
    row = scores.filter("held").agg(
        *[F.avg(F.when(F.col("action") == k, F.col("score"))).alias(f"m_{k}") for k in ("allow", "block")],
        *[F.stddev_pop(F.when(F.col("action") == k, F.col("score"))).alias(f"s_{k}") for k in ("allow", "block")],
    ).first()
    if row.m_allow is None or row.m_block is None:
        return float("-inf")
    wide = row.s_allow + row.s_block
    if not wide:
        return (row.m_allow + row.m_block) / 2
    return (row.m_allow * row.s_block + row.m_block * row.s_allow) / wide


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id``, host, path, rule (of the longest that fits), score and verdict of every row of ``pages``.

    A null URL, or one without ``://``, has an empty host and path, no score, and is allowed; so is one whose score
    reaches the threshold. Copies of a URL get the same verdict, URLs of any length are judged whole, and an empty table
    gives no rows. Other columns are ignored.
    """
    host, path = host_and_path()
    judged = (
        pages.select("page_id", "url")
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": first_rule(rules, lambda r: r.text), "action": first_rule(rules, lambda r: r.action)})
    )
    scores = written(score_urls(judged, HELD_OUT), "url-scores")
    limit = threshold(scores)
    scores = scores.select(F.col("url").alias("__url"), "score")
    by_model = F.when(F.col("score") < limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(scores, judged["url"] == scores["__url"], "left").select(
        "page_id", "url", "host", "path", "rule", "score", F.coalesce("action", by_model).alias("verdict")
    )
