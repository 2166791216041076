"""URL filter: rules of hosts and path prefixes, and for the rest a logistic regression on
hashed character n-grams of host and path.

A rule like ``example.net/en/`` fits its host and all subdomains of it when the path starts
with the rule's path; the longest fitting rule decides. The regression (MLlib) is trained
from a small table of labelled urls: at most ``max_rows`` distinct (host, path) pairs of the
table that a rule decides, taken in the order of a hash. Host and path n-grams are told
apart and a host's end and a path's start are marked, so "net" at the end of a host is its
own feature.

Defined results: a null url or one without ``://`` has empty host and path and no rule; with
labels of one kind only, that verdict is given to all, without any label ``default``; equal
rows get equal results; other columns are never read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))
MAX_ROWS = 10_000
N_FEATURES = 1 << 14
GRAMS = (3, 4, 5)


def split_url(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a url."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id`` with host, path, the longest fitting rule and its verdict (else null)."""
    host, path = split_url(F.col("url"))
    rule = verdict = F.lit(None).cast("string")
    for text, kind in sorted(rules, key=lambda r: len(r[0])):
        site, _, tail = text.partition("/")
        fits = ((F.col("host") == site) | F.col("host").endswith("." + site)) \
            & F.col("path").startswith("/" + tail)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("rule", rule).withColumn("rule_verdict", verdict))


def _grams(chars: str, mark: str) -> list[F.Column]:
    """Marked n-grams of each length, from a column of characters."""
    def of(n):
        at = F.sequence(F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(1)))
        return F.transform(at, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(F.col(chars), i, n), "")))

    return [of(n) for n in GRAMS]


def features(urls: DataFrame) -> DataFrame:
    """Adds ``grams`` (distinct marked n-grams) and ``features`` (hashed, 0 or 1). A text is cut
    into characters once, in a column of its own, so the work follows its length, also that of
    a data url of a megabyte."""
    cut = lambda c: F.regexp_extract_all(F.concat(F.lit("^"), F.col(c), F.lit("$")), F.lit("(?s)."), F.lit(0))
    urls = urls.withColumns({"host_chars": cut("host"), "path_chars": cut("path")})
    grams = F.array_distinct(F.concat(*_grams("host_chars", "h"), *_grams("path_chars", "p")))
    urls = urls.withColumn("grams", grams).drop("host_chars", "path_chars")
    tf = HashingTF(numFeatures=N_FEATURES, binary=True, inputCol="grams", outputCol="features")
    return tf.transform(urls)


def fit_urls(judged: DataFrame, max_rows: int = MAX_ROWS) -> LogisticRegressionModel | str | None:
    """Regression for P(block) from rows of ``with_rules`` that a rule decides; the one
    verdict there is, if there is only one; None without any."""
    known = (judged.where("rule_verdict is not null").select("host", "path", "rule_verdict").distinct()
             .orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_rows).collect())
    kinds = {r["rule_verdict"] for r in known}
    if len(kinds) < 2:
        return kinds.pop() if kinds else None
    spark = judged.sparkSession
    small = spark.createDataFrame([(r["host"], r["path"], float(r["rule_verdict"] == "block"))
                                   for r in known], "host string, path string, label double")
    return LogisticRegression(regParam=1e-3, maxIter=50, standardization=False).fit(
        features(small.coalesce(1)))


def url_filter(pages: DataFrame, rules=RULES, max_rows: int = MAX_ROWS,
               default: str = "allow") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and p_block of the regression (null
    where there is none)."""
    judged = with_rules(pages, rules)
    model = fit_urls(judged, max_rows)
    if isinstance(model, LogisticRegressionModel):
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(features(judged))
        p = vector_to_array("probability")[1]
    else:
        scored, p = judged, F.lit(None).cast("double")
    own = F.when(p >= 0.5, "block").when(p < 0.5, "allow").otherwise(model if isinstance(model, str) else default)
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", own).alias("verdict"), p.alias("p_block"))
