"""URL filters (operator 10): host/path rules, and a logistic regression on hashed
character n-grams of host and path for URLs that no rule fits.

All steps are DataFrame expressions and Spark ML's JVM estimators: URL parsing and
n-grams are built-in functions, the n-grams are hashed by ``HashingTF`` and the model
is fitted by ``LogisticRegression`` on the small labelled URL table. Only the URL
columns are read, and no row is shuffled: rules and coefficients travel with the plan.

Defined cases: a null URL or one without ``://`` has empty host and path and gets the
model's verdict for the empty URL; a rule fits only if the path starts with its path
(a URL that ends after its host fits no rule); of equally long rules block wins; an
empty page table gives an empty result; rows repeat as they come; other columns of the
page table are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_az, table

#: (host, path prefix, verdict). The rule list is part of the plan: keep it to hundreds.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
MAX_RULES = 500

#: The labelled URL table is made by a rule from these words: what a curator blocks by topic, and lures that go with it;
#: subjects and kinds of sites that are allowed. No host of it is a host of the given pages.
TOPICS = ("casino", "poker", "slots", "bets", "betting", "lottery", "jackpot", "pills", "meds", "viagra", "loans", "payday", "xxx", "cams", "replica", "prizes")
LURES = ("bonus", "online", "best", "now", "cheap", "buy", "shop", "money", "fast", "club", "deals")
SUBJECTS = ("library", "garden", "weather", "history", "museum", "physics", "recipes", "school", "harbour", "letters", "bridge", "forest",
            "theatre", "painting", "rowing", "astronomy")
KINDS = ("news", "blog", "docs", "maps", "archive", "wiki", "journal", "forum", "m", "www", "")
LANGUAGES = ("en", "fr", "de", "es")
DOMAINS = ("com", "net", "org")


def host_column(url: Column) -> Column:
    return lower_az(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def path_column(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit in a plan")
    longest_first = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(longest_first):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        hit = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Distinct character n-grams of ``^host$`` and ``path$``, tagged by part and size."""
    parts = []
    for tag, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(path, F.lit("$")))):
        # characters first: taking substrings out of a long text walks over it again for each
        letters = F.array(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
        parts += [F.flatten(F.transform(letters, _windows(n, f"{tag}{n}:"))) for n in sizes]
    return F.array_distinct(F.concat(*parts))


def _windows(n: int, tag: str) -> Callable[[Column], Column]:
    """Function of an array of characters: the strings of n that follow each other in it."""
    def grams(letters: Column) -> Column:
        firsts = F.slice(letters, 1, F.greatest(F.size(letters) - (n - 1), F.lit(0)))
        return F.transform(firsts, lambda first, i: F.concat(F.lit(tag), first, *[F.get(letters, i + k) for k in range(1, n)]))
    return grams


@dataclass
class UrlModel:
    """Hashing width and fitted coefficients; both are fixed-size model parameters."""
    hasher: HashingTF
    model: LogisticRegressionModel

    def block_probability(self, df: DataFrame, grams: str, out: str) -> DataFrame:
        scored = self.model.transform(self.hasher.transform(df))
        return scored.withColumn(out, F.get(vector_to_array("_url_probability"), F.lit(1)))


def fit_url_model(labelled: DataFrame, features: int = 1 << 14, reg: float = 0.01, iterations: int = 25) -> UrlModel:
    """Fit on a small labelled table (url, label 1 = block); rows with null labels are left out."""
    hasher = HashingTF(numFeatures=features, binary=True, inputCol="_url_grams", outputCol="_url_features")
    train = labelled.where(F.col("label").isNotNull()).select(
        ngrams(host_column(F.col("url")), path_column(F.col("url"))).alias("_url_grams"),
        F.col("label").cast("double").alias("_url_label"))
    lr = LogisticRegression(featuresCol="_url_features", labelCol="_url_label", regParam=reg, maxIter=iterations,
                            probabilityCol="_url_probability", rawPredictionCol="_url_raw", predictionCol="_url_prediction")
    return UrlModel(hasher, lr.fit(hasher.transform(train)))


def _url(n: int, host: str) -> str:
    """The n-th labelled URL: scheme, domain, language, page number and ending vary with n alike for both labels."""
    ending = ("", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed")[n % 6]
    return f"http{'s' * (n % 2)}://{host}.example.{DOMAINS[n % 3]}/{LANGUAGES[n % 4]}/{(n * 7919) % 9000 + 100}{ending}"


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label, topic): about 350 invented URLs, 1 = block; ``topic`` is the word that the host is about."""
    rows = [(_url(n, ("www." * (n % 5 == 0) + (f"{t}-{w}" if n % 2 else f"{w}-{t}"))), 1, t)
            for n, (t, w) in enumerate((t, w) for t in TOPICS for w in LURES)]
    # invented names of two to four syllables stand among the subjects, as sites are not all called by words
    syllables = ("an", "tor", "ing", "le", "mar", "ou", "sen", "ri")
    names = [*SUBJECTS[:8], *("".join(syllables[(i * k + k) % 8] for k in range(1, 3 + i % 3)) for i in range(8))]
    rows += [(_url(n, f"{k}.{s}" if k else s), 0, s) for n, (s, k) in enumerate((s, k) for s in names for k in KINDS)]
    return spark.createDataFrame(rows, "url string, label int, topic string").coalesce(1)


def cross_validated(labelled: DataFrame, folds: int = 4) -> DataFrame:
    """(url, label, block_score): every labelled URL scored by a model that saw no URL of its topic."""
    fold = F.pmod(F.xxhash64("topic"), F.lit(folds))
    parts = []
    for f in range(folds):
        model = fit_url_model(labelled.where(fold != f))
        own = labelled.where(fold == f).withColumn("_url_grams", ngrams(host_column(F.col("url")), path_column(F.col("url"))))
        parts.append(model.block_probability(own, "_url_grams", "block_score").select("url", "label", "block_score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) for every row of ``pages``."""
    model = fit_url_model(labelled)
    parsed = pages.select("page_id", host_column(F.col("url")).alias("host"), path_column(F.col("url")).alias("path"))
    parsed = parsed.select("*", rule_column(F.col("host"), F.col("path"), rules).alias("_rule"),
                           ngrams(F.col("host"), F.col("path")).alias("_url_grams"))
    scored = model.block_probability(parsed, "_url_grams", "block_score")
    own = F.when(F.col("block_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                         F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "block_score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), labelled_urls(spark))
