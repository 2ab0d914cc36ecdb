"""URL filter: rules first, then gradient-boosted trees on lexical features.

Rules are pairs of host and path. A rule fits its host and all subdomains of it when
the url's path starts with the rule's; the longest that fits decides. Urls that a
rule decides are the labelled ones from which the trees learn; all others get the
trees' verdict.

Features: length, path depth, digit ratio, character entropy, number of parameters,
host labels, hyphens, and for the last and the last two host labels how many urls have
them and what smoothed share of their labelled urls is blocked. These counts are over
all urls. The trees are fitted on the first ``SAMPLE`` labelled urls by hash, a
documented bound.

Null urls and urls without ``://`` have empty host and path and fit no rule. If the
labelled urls are all of one class, the trees say that class; if there are none, they
say allow. Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkspark.plans.registry import query
from chunkspark.session import read_table

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SAMPLE = 5_000
TREES, DEPTH = 10, 3
SMOOTHING = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_hyphens", "f_tld_n", "f_tld_block", "f_site_n", "f_site_block")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that decides and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for where, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == where) | F.endswith(host, F.lit("." + where))) & F.startswith(path, F.lit(start))
        name = F.when(fits, F.lit(where + start)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _entropy(url: Column) -> Column:
    """Bits per character."""
    size = F.length(url).cast("double")
    letters = F.array_distinct(F.split(url, ""))

    def add(total, letter):
        share = (size - F.length(F.replace(url, letter, F.lit("")))) / size
        return total + F.when((letter == "") | (share <= 0), 0.0).otherwise(-share * F.log2(share))

    return F.when(size > 0, F.aggregate(letters, F.lit(0.0), add)).otherwise(0.0)


def judge(urls: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' block score of every url."""
    text = F.col(f"`{url}`").cast("string")
    host, path = parts(text)
    rows = urls.select(F.col(f"`{page_id}`").alias("page_id"), F.coalesce(text, F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    labels = F.split("host", r"\.")
    rows = rows.select(
        "*", F.element_at(labels, -1).alias("tld"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".").alias("site"),
        F.log1p(F.length("url")).alias("f_length"), F.regexp_count("path", F.lit("/")).cast("double").alias("f_depth"),
        (F.regexp_count("url", F.lit("[0-9]")) / F.greatest(F.length("url"), F.lit(1))).alias("f_digits"),
        _entropy(F.col("url")).alias("f_entropy"), F.regexp_count("url", F.lit("[?&]")).cast("double").alias("f_params"),
        F.size(labels).cast("double").alias("f_labels"), F.regexp_count("host", F.lit("-")).cast("double").alias("f_hyphens"),
    )
    blocked, allowed = F.count_if(F.col("ruled") == "block"), F.count_if(F.col("ruled") == "allow")
    classes = rows.agg(blocked.alias("b"), allowed.alias("a")).first()
    if not classes["b"] or not classes["a"]:
        scored = rows.withColumn("block_score", F.lit(1.0 if classes["b"] else 0.0))
        return scored.select("page_id", "host", "path", "rule", F.coalesce(
            "ruled", F.lit("block" if classes["b"] else "allow")).alias("verdict"), "block_score")
    prior = classes["b"] / (classes["b"] + classes["a"])
    for end in ("tld", "site"):
        stats = rows.groupBy(end).agg(
            F.log1p(F.count(F.lit(1))).alias(f"f_{end}_n"),
            ((blocked + SMOOTHING * prior) / (blocked + allowed + SMOOTHING)).alias(f"f_{end}_block"))
        rows = rows.join(stats, end)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    drawn = rows.filter(F.col("ruled").isNotNull()).select("features", (F.col("ruled") == "block").cast("double").alias("label"),
                                                          F.xxhash64("url").alias("o"), "url")
    sample = drawn.orderBy("o", "url").limit(SAMPLE).select("features", "label").coalesce(1).persist()
    two = sample.select(F.countDistinct("label")).first()[0] > 1
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(sample) if two else None
    sample.unpersist()
    if model is None:
        scored = rows.withColumn("block_score", F.lit(prior))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(rows).withColumn("block_score", F.element_at(vector_to_array("probability"), 2))
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "block_score")


@query("op4_url_filter")
def op4_url_filter(spark, sf_dir):
    return judge(read_table(spark, sf_dir, "pages"))
