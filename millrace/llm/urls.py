"""URL filtering by rules and a character language-model ratio, in DataFrame functions only.

URLs that a rule decides are the training set: accepted and rejected ones each give a
variable-order Markov model over the characters of the whole URL (orders 0 to ``ORDER``,
Witten-Bell interpolation; a context that was never seen leaves the prediction to the next
shorter one). An undecided URL is judged by the difference of its log-likelihoods under the two,
per character, against a threshold calibrated on decided URLs that the models have not seen.

Equal URLs are counted and judged once. Each character is counted once, behind its longest
context; the tables of shorter contexts are summed from those of longer ones. These tables grow
with the URLs and are joined, never gathered. Characters that begin every URL, and a URL that
very many pages share, are looked up where their rows are. Scores are added as whole numbers, so
that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import join_counted, stored

#: Longest context, and the number of characters among which an unseen one is one.
ORDER, ALPHABET = 5, 256
#: Marks before the first and behind the last character.
BEGIN, END = "\x02", "\x03"
#: One in so many decided URLs calibrates the threshold and is not learnt from.
FOLDS = 4
#: Scores of characters are whole multiples of 1 / ``UNIT``.
UNIT = 10**9
#: Bins of the calibration's histogram per unit of log-likelihood, and its bounds.
FINE, FAR = 50, 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; null, or no ``://``: both empty."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The struct (rule, verdict) of the longest fitting rule, or null. Rules: (verdict, host, path)."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    if not order:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    known = F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in order))
    fits = F.filter(known, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    first = F.get(fits, F.lit(0))
    return F.when(F.size(fits) > 0, F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


def grams(url: Column) -> Column:
    """Every character of a URL (and the end mark) behind its longest context."""
    characters = F.split(F.concat(F.lit(BEGIN * ORDER), url, F.lit(END)), "")
    each = lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - ORDER), lambda i: F.array_join(F.slice(c, i, ORDER + 1), ""))
    return F.flatten(F.transform(F.array(characters), each))  # in an array of one, so that the URL is split once


def probabilities(counted: DataFrame) -> DataFrame:
    """(gram, score, n) for the longest grams: the log of the ratio of the character's probabilities in the accepted and the rejected model, and how often it occurs.

    ``counted``: url, accepted, rejected (how many pages of that URL the models learn from as which).
    """
    grouped = lambda rows: rows.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.sum("n").alias("n"))
    longest = counted.select(F.explode(grams(F.col("url"))).alias("gram"), F.col("accepted").alias("a"), F.col("rejected").alias("r"), F.lit(1).cast("long").alias("n"))
    levels = [stored(grouped(longest), "url-grams")]
    for _ in range(ORDER):
        levels.append(stored(grouped(levels[-1].withColumn("gram", F.expr("substr(gram, 2)"))), "url-grams"))
    seen = lambda c: F.sum((F.col(c) > 0).cast("long"))
    shorter = None
    for size, level in enumerate(reversed(levels), 1):
        level = level.withColumn("context", F.substr("gram", F.lit(1), F.lit(size - 1)))
        contexts = level.groupBy("context").agg(F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), seen("a").alias("kinds_a"), seen("r").alias("kinds_r"))
        own = level.join(contexts, "context")
        if shorter is None:
            own = own.withColumns({"low_a": F.lit(1.0 / ALPHABET), "low_r": F.lit(1.0 / ALPHABET)})
        else:
            own = own.withColumn("suffix", F.expr("substr(gram, 2)")).join(shorter, "suffix")
        smooth = lambda c: F.when(F.col(f"all_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * F.col(f"low_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"low_{c}"))
        own = stored(own.select("gram", smooth("a").alias("low_a"), smooth("r").alias("low_r"), "n"), "url-probabilities")
        shorter = own.select(F.col("gram").alias("suffix"), "low_a", "low_r")
    return stored(own.select("gram", F.round(F.log(F.col("low_a") / F.col("low_r")) * UNIT).cast("long").alias("score"), "n"), "url-scores")


def scored(counted: DataFrame) -> DataFrame:
    """key, n, accepted, rejected, held_accepted, held_rejected of each row of ``counted``, and score: the mean of the characters' log-ratios."""
    known = probabilities(counted)
    total = known.agg(F.sum("n")).first()[0] or 0
    parts = counted.select("key", F.explode(grams(F.col("url"))).alias("gram"))
    means = join_counted(parts, known, "gram", total).groupBy("key").agg((F.sum("score") / F.count("*") / UNIT).alias("score"))
    return stored(counted.drop("url").join(means, "key"), "url-means")


def threshold(rows: DataFrame) -> float | None:
    """The score from which URLs are accepted: least sum of the two error rates on decided URLs; None if one kind is lacking.

    It lies in the middle of the empty bins between the scores it parts. URLs held out decide; if
    they are all of one kind, all decided URLs do. A histogram of fixed size reaches the driver.
    """
    place = F.greatest(F.lit(-FAR * FINE), F.least(F.lit(FAR * FINE), F.floor(F.col("score") * FINE)))
    names = {"held": ("held_accepted", "held_rejected"), "all": ("accepted", "rejected")}
    sums = [F.sum(c).alias(c) for pair in names.values() for c in pair]
    bins = rows.groupBy(place.alias("bin")).agg(*sums).orderBy("bin").collect()
    counts = {who: [(b["bin"], b[a] + (b["held_accepted"] if who == "all" else 0), b[r] + (b["held_rejected"] if who == "all" else 0)) for b in bins] for who, (a, r) in names.items()}
    for own in (counts["held"], counts["all"]):
        own = [b for b in own if b[1] or b[2]]
        all_a, all_r = sum(a for _, a, _ in own), sum(r for _, _, r in own)
        if not all_a or not all_r:
            continue
        best, at, lost_a, lost_r, end = 2.0, 0.0, 0, 0, own[0][0]
        for start, a, r in own:
            error = lost_a / all_a + (all_r - lost_r) / all_r  # accepting from this bin on
            if error < best:
                best, at = error, (end + start) / 2
            lost_a, lost_r, end = lost_a + a, lost_r + r, start + 1
        return at / FINE
    return None


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), score of every row of ``pages`` (page_id, url).

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with the
    rule's; the longest wins. Other URLs are judged by the models, whole as they are written; null
    ones as the empty text. If no URL is accepted, or none rejected, by a rule, the undecided are
    allowed. Of decided URLs one in ``FOLDS``, by a hash of the URL, is kept from the models and
    calibrates. Equal URLs get equal verdicts, known by 128 bits of their SHA-256; repeated rows
    are each returned; other columns are not looked at; no rows give no rows.
    """
    host, path = host_and_path(F.col("url"))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    key = F.unhex(F.substring(F.sha2(url, 256), 1, 32))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"), url.alias("url"), key.alias("key"))
    rows = rows.withColumn("rule", ruled(F.col("host"), F.col("path"), rules))
    rows = stored(rows.select("page_id", "host", "path", "rule.rule", F.col("rule.verdict").alias("said"), "url", "key"), "url-rows")
    held = F.pmod(F.xxhash64("key"), F.lit(FOLDS)) == 0
    is_ = lambda v, which: F.sum((F.coalesce(F.col("said") == v, F.lit(False)) & which).cast("long"))
    kinds = [is_(v, which).alias(name) for v, which, name in (("allow", ~held, "accepted"), ("block", ~held, "rejected"), ("allow", held, "held_accepted"), ("block", held, "held_rejected"))]
    counted = stored(rows.groupBy("key", "url").agg(F.count("*").alias("n"), *kinds), "url-counts")
    scores = scored(counted)
    least = threshold(scores)
    total = scores.agg(F.sum("n")).first()[0] or 0
    out = join_counted(rows.drop("url"), scores.select("key", "score", "n"), "key", total)
    own = F.lit("allow") if least is None else F.when(F.col("score") >= least, "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"), "score")
