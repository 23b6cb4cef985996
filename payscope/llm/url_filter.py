"""URL filter: explicit rules, and boosted trees on lexical features.

``train`` fits gradient-boosted trees on labelled URLs; ``judge`` gives each
URL the verdict of the longest matching rule, else that of the trees.  The
trees see lexical features only: lengths, path depth, digit and hyphen
ratios, character entropy, parameter counts and suffix statistics (how often
labelled URLs under the same host suffix are bad).

Scale: suffix statistics cover every labelled URL; suffixes are hashed into
``SUFFIX_BUCKETS`` buckets, so the statistics table has a fixed largest size
(65536 rows of 20 bytes) and is broadcast, and a host with a third of all
URLs is pre-aggregated before the shuffle.  The trees are fitted on a sample of
about ``max_train_rows`` labelled URLs, a documented bound.  Judging is one
scan without a shuffle.

Defined results: a null URL, or one without ``://``, has an empty host and
path, matches no rule and is judged by the trees like any other.  Repeated
rows are judged alike.  With an empty table, or labels of one class only, no
trees are fitted and the prior label (allow if there is none) is the verdict.
Further columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import require, stored

SUFFIX_BUCKETS = 65536
SUFFIX_LABELS = (1, 2, 3)  # statistics for the last one, two and three host labels
PRIOR_WEIGHT = 5.0

# Words that mark a host as advertising, gambling, spam or adult when one of
# its labels has them between hyphens; used to label URLs for training.
BAD_HOST_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam", "track", "xxx")

FEATURES = ["url_length", "host_length", "path_length", "query_length", "depth", "host_labels",
            "digit_ratio", "hyphen_ratio", "host_hyphens", "entropy", "parameters", "has_fragment"]


@dataclass(frozen=True)
class Rule:
    """``host/path`` pattern: the host and its subdomains, paths by prefix."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"),
         Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null; rules of one
    length are tried in text order."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text).cast("double")
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c))) / n
    return F.when(n > 0, -F.aggregate(letters, F.lit(0.0), lambda s, c: s + share(c) * F.log2(share(c)))).otherwise(0.0)


def _suffix_bucket(host: Column, labels: int) -> Column:
    suffix = F.substring_index(host, ".", -labels)
    return F.pmod(F.xxhash64(F.lit(labels), suffix), F.lit(SUFFIX_BUCKETS)).cast("int")


def with_features(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, the lexical features and the suffix buckets."""
    u = F.coalesce(F.col(url), F.lit(""))
    out = urls.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    n = F.greatest(F.length(u), F.lit(1))
    return out.withColumns({
        "url_length": F.length(u).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "query_length": F.length(query).cast("double"),
        "depth": F.regexp_count("path", F.lit("[^/]+")).cast("double"),
        "host_labels": F.regexp_count("host", F.lit("[^.]+")).cast("double"),
        "digit_ratio": F.regexp_count(u, F.lit("[0-9]")) / n,
        "hyphen_ratio": F.regexp_count(u, F.lit("[-_]")) / n,
        "host_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "entropy": _entropy(u),
        "parameters": F.regexp_count(query, F.lit("[^&;]+")).cast("double"),
        "has_fragment": F.contains(u, F.lit("#")).cast("double"),
        **{f"bucket_{k}": _suffix_bucket(F.col("host"), k) for k in SUFFIX_LABELS},
    })


def host_word_label(host: Column, words: tuple[str, ...] = BAD_HOST_WORDS) -> Column:
    """1 if a label of the host has one of ``words`` between hyphens, 0 if
    not, null without a host."""
    bad = host.rlike(r"(^|[.\-])(" + "|".join(words) + r")([.\-]|$)")
    return F.when(host != "", bad.cast("double"))


def suffix_statistics(featured: DataFrame, label: str) -> DataFrame:
    """(bucket, n, bad) over every labelled URL; at most SUFFIX_BUCKETS rows."""
    buckets = F.explode(F.array(*[f"bucket_{k}" for k in SUFFIX_LABELS]))
    return (featured.select(buckets.alias("bucket"), F.col(label).alias("y"))
            .groupBy("bucket").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("bad")))


def _with_suffix_features(featured: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    out = featured
    for k in SUFFIX_LABELS:
        side = F.broadcast(stats.select(F.col("bucket").alias(f"bucket_{k}"), F.col("n").alias("_n"), F.col("bad").alias("_bad")))
        n, bad = F.coalesce("_n", F.lit(0.0)), F.coalesce("_bad", F.lit(0.0))
        out = (out.join(side, f"bucket_{k}", "left")
               .withColumn(f"suffix_rate_{k}", (bad + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT))
               .withColumn(f"suffix_seen_{k}", F.log1p(n)).drop("_n", "_bad"))
    return out


@dataclass(frozen=True)
class UrlModel:
    """Fitted trees (None if one class only), suffix statistics, share of bad URLs."""

    trees: GBTClassificationModel | None
    stats: DataFrame
    prior: float

    def score(self, featured: DataFrame, column: str = "bad_score") -> DataFrame:
        """``featured`` with the probability that a URL is bad."""
        if self.trees is None:
            return featured.withColumn(column, F.lit(self.prior))
        names = _vector_names()
        rich = _with_suffix_features(featured, self.stats, self.prior)
        rich = VectorAssembler(inputCols=names, outputCol="_features").transform(rich)
        rich = self.trees.transform(rich)
        return (rich.withColumn(column, vector_to_array("probability")[1])
                .drop("_features", "rawPrediction", "probability", "prediction", *names[len(FEATURES):]))


def _vector_names() -> list[str]:
    return FEATURES + [f"suffix_{what}_{k}" for what in ("rate", "seen") for k in SUFFIX_LABELS]


def train(labelled: DataFrame, url: str = "url", label: str = "label",
          max_train_rows: int = 20000, rounds: int = 12, depth: int = 4) -> UrlModel:
    """Fit on labelled URLs (label 1 bad, 0 good; null: not labelled).

    Statistics and prior cover all labelled rows.  The trees are fitted on
    a sample by hash of the URL whose expected size is ``max_train_rows``
    per class, so that a rare class is not lost.
    """
    featured = with_features(require(labelled, [url, label]).where(F.col(label).isin(0.0, 1.0)), url)
    per_class = {r["y"]: r["n"] for r in featured.groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    total = sum(per_class.values())
    prior = per_class.get(1.0, 0) / total if total else 0.0
    stats = suffix_statistics(featured, label)
    if not (per_class.get(0.0) and per_class.get(1.0)):
        return UrlModel(None, stats, prior)
    stats = stored(stats, "url-suffixes")
    share = lambda y: min(1.0, max_train_rows / per_class[y])
    unit = F.pmod(F.xxhash64(F.lit(17), F.coalesce(F.col(url), F.lit(""))), F.lit(1 << 30)) / float(1 << 30)
    sample = featured.where(unit < F.when(F.col(label) == 1.0, share(1.0)).otherwise(share(0.0)))
    names = _vector_names()
    rich = _with_suffix_features(sample, stats, prior).select(
        *names, F.col(label).alias("_label"),
        (F.when(F.col(label) == 1.0, 1.0 / per_class[1.0] / share(1.0)).otherwise(1.0 / per_class[0.0] / share(0.0)) * float(max_train_rows)).alias("_weight"))
    # the sample is stored, so that the fit's many passes read some ten thousand rows of a few
    # files, and the table itself is scanned by as many tasks as it has parts
    data = VectorAssembler(inputCols=names, outputCol="_features").transform(stored(rich, "url-sample")).select("_features", "_label", "_weight")
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", weightCol="_weight",
                          maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7).fit(data.coalesce(4))
    return UrlModel(trees, stats, prior)


def judge(urls: DataFrame, model: UrlModel, url: str = "url", keep: tuple[str, ...] = ("page_id",),
          rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The ``keep`` columns of ``urls`` with host, path, rule, verdict (allow
    or block), bad_score and the lexical features."""
    narrow = urls.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_keep"), F.col(f"`{url}`").alias("_url"))
    scored = model.score(with_features(narrow, "_url"))
    rule = longest_rule(F.col("host"), F.col("path"), rules, lambda r: r.text)
    verdict = longest_rule(F.col("host"), F.col("path"), rules, lambda r: r.verdict)
    learned = F.when(F.col("bad_score") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("_keep.*", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"),
                         "bad_score", *FEATURES)
