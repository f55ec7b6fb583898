"""URL filter by the ratio of two character language models.

Rules (host suffix and path beginning, the longest wins) judge the URLs they
fit.  Those URLs train two smoothed variable-order Markov models, one on the
allowed and one on the blocked; a URL that no rule fits is judged by the
difference of its log-likelihoods under both, divided by its length.

A character's probability is interpolated from contexts of up to four
characters by Witten-Bell weights; a context that the training lacks drops
out, so the order varies with what is known.  The cut is calibrated on the
training URLs: the point equally many standard deviations from both classes'
mean scores.

The models read the characters of host and path as they are.  Pages of one URL
are aggregated first and enter every count, mean and deviation with their
number, so a URL with a third of all pages weighs as much as it has pages and
costs as much as any other; window probabilities are worked out once per
distinct five-character window.  DataFrame functions only.

Defined results: a null URL or one without ``://`` has empty host and path
and fits no rule; without URLs of both classes the models know nothing and
the verdict is allow; repeated rows get equal verdicts; an empty table gives
no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapflow.llm.common import written

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGITS = 9                      # decimals at which scores are compared


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict)."""
    fits = []
    for verdict, rule in rules:
        name, _, start = rule.partition("/")
        fit = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"),
                                         F.lit(verdict).alias("verdict"))))
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def probability(c: str) -> str:
    """SQL for a window's probability in class ``c`` (a or b) by order, from
    the counts of its endings (n), contexts (m) and their continuations (t)."""
    yield 1, f"(n1{c} + 1e0) / (total_{c} + letters + 1e0)"
    for k in range(2, ORDER + 1):
        n, m, t, shorter = f"n{k}{c}", f"m{k}{c}", f"t{k}{c}", f"p{k - 1}{c}"
        yield k, f"CASE WHEN {m} > 0 THEN ({n} + {t} * {shorter}) / ({m} + {t}) ELSE {shorter} END"


def window_columns(text: Column) -> Column:
    """The windows that end at each character of the text and at its end."""
    letters = F.concat(F.array(*[F.lit("^")] * (ORDER - 1)), F.filter(F.split(text, ""), lambda x: x != ""),
                       F.array(F.lit("$")))
    # an array of one array: a lambda's variable is worked out once, an expression inside it once per window
    return F.transform(F.array(letters), lambda a: F.transform(
        F.sequence(F.lit(1), F.size(a) - (ORDER - 1)), lambda i: F.array_join(F.slice(a, i, F.lit(ORDER)), "")))[0]


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, score."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).select(
        "id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"))
    rows = written(rows, "url-rows")
    # the verdict of a rule depends on host and path alone; the number keeps long URLs out of the window rows
    urls = written(rows.groupBy("host", "path").agg(F.max("ruled").alias("ruled"), F.count(F.lit(1)).alias("pages"))
                   .withColumn("url", F.monotonically_increasing_id()), "url-distinct")
    windows = written(urls.select("url", "pages", "ruled", F.explode(window_columns(F.concat("host", "path"))).alias("w")),
                      "url-windows")

    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    seen = lambda verdict: F.sum(F.when(F.col("ruled") == verdict, F.col("pages")).otherwise(0))
    counts = windows.groupBy("w").agg(seen("allow").alias("a"), seen("block").alias("b"))
    endings = F.explode(F.transform(F.sequence(F.lit(1), F.lit(ORDER)),
                                    lambda k: F.struct(k.alias("k"), F.expr("w").substr(ORDER + 1 - k, k).alias("g"))))
    long = written(counts.select("w", "a", "b", endings.alias("e")).select("w", "a", "b", "e.k", "e.g"), "url-grams")
    grams = long.groupBy("k", "g").agg(F.sum("a").alias("na"), F.sum("b").alias("nb")).where("na + nb > 0")
    grams = written(grams, "url-gram-counts")
    contexts = (grams.where("k > 1").groupBy("k", F.col("g").substr(F.lit(1), F.col("k") - 1).alias("c"))
                .agg(F.sum("na").alias("ma"), F.sum("nb").alias("mb"),
                     one(F.col("na") > 0).alias("ta"), one(F.col("nb") > 0).alias("tb")))
    contexts = written(contexts, "url-contexts")
    sums = grams.where("k = 1").agg(F.coalesce(F.sum("na"), F.lit(0)).alias("total_a"),
                                    F.coalesce(F.sum("nb"), F.lit(0)).alias("total_b"),
                                    F.count(F.lit(1)).alias("letters")).first()
    if not (sums["total_a"] and sums["total_b"]):
        return rows.select(F.col("id").alias(id_col), "host", "path", "rule",
                           F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))

    full = (long.select("w", "k", "g", F.col("g").substr(F.lit(1), F.col("k") - 1).alias("c"))
            .join(grams, ["k", "g"], "left").join(contexts, ["k", "c"], "left"))
    pick = lambda k, c: F.coalesce(F.sum(F.when(F.col("k") == k, F.col(c))), F.lit(0))
    wide = full.groupBy("w").agg(*[pick(k, f"{x}{c}").alias(f"{x}{k}{c}")
                                   for k in range(1, ORDER + 1) for x in "nmt" for c in "ab" if k > 1 or x == "n"])
    for name in ("total_a", "total_b", "letters"):
        wide = wide.withColumn(name, F.lit(sums[name]))
    for c in "ab":
        for k, p in probability(c):
            wide = wide.withColumn(f"p{k}{c}", F.expr(p))
    ratios = written(wide.select("w", F.log(F.col(f"p{ORDER}a") / F.col(f"p{ORDER}b")).alias("r")), "url-ratios")
    scores = windows.join(ratios, "w").groupBy("url").agg(F.round(F.avg("r"), DIGITS).alias("score"))
    urls = written(urls.join(scores, "url").drop("url"), "url-scores")

    of_pages = lambda x: F.sum(x * F.col("pages")) / F.sum("pages")
    side = {r["ruled"]: r for r in urls.where("ruled IS NOT NULL").groupBy("ruled").agg(
        of_pages(F.col("score")).alias("m"), of_pages(F.col("score") * F.col("score")).alias("q")).collect()}
    deviation = {v: math.sqrt(max(0.0, r["q"] - r["m"] ** 2)) for v, r in side.items()}
    cut = threshold(side["allow"]["m"], deviation["allow"], side["block"]["m"], deviation["block"])
    # both sides are scans: a hot URL's partition can be split at run time
    judged = F.when(F.col("score") >= F.lit(cut), "allow").otherwise("block")
    return (rows.join(urls.select("host", "path", "score"), ["host", "path"])
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("ruled", judged).alias("verdict"), "score"))


def threshold(ma: float, sa: float, mb: float, sb: float) -> float:
    """Equally many standard deviations from both means."""
    cut = (ma * sb + mb * sa) / (sa + sb) if sa + sb > 0 else (ma + mb) / 2
    return round(cut, 6)
