"""URL verdicts: longest matching rule, else gradient-boosted trees on lexical features.

The trees are trained on a bounded sample of the different URLs that rules label, drawn and weighted by label, with
Spark's own GBT; features are column expressions. Suffix statistics (how many URLs a suffix has and how often its
labelled ones are blocked) come from grouped counts over all different URLs. No Python runs on executors.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.llm.common import drop_stage, stage

#: About so many labelled URLs at most train the trees, half of either label.
TRAIN_ROWS = 20_000
DRAWS = 1 << 40
TREES = 20
DEPTH = 4
SEED = 7
PRIOR = 20.0
BROADCAST_SUFFIXES = 100_000


class Rule(NamedTuple):
    """A verdict for a host, its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and ``query``; all empty for a null url or one without ``://``."""
    start = F.instr(F.col(url), "://")
    rest = F.when(start > 0, F.substring(F.col(url), start + 3, F.length(F.col(url)))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract("_rest", r"(?s)^[^?#]*\?([^#]*)", 1)
    return df.withColumn("_rest", rest).withColumns({"host": lower_ascii(host), "path": path, "query": query}).drop("_rest")


def matching_rule(rules: tuple[Rule, ...]) -> Column:
    """Name of the longest rule that fits, else null. Rules are few: they become one expression."""
    fits = lambda r: ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    return F.coalesce(*(F.when(fits(r), F.lit(r.name)) for r in ordered), F.lit(None).cast("string"))


def count_of(text: Column, pattern: str) -> Column:
    """Occurrences of a pattern."""
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy of a text's letters, digits and separators, in bits a character."""
    kinds = F.array(*map(F.lit, [*"abcdefghijklmnopqrstuvwxyz0123456789", "-", "_", ".", "/"]))
    shares = F.transform(kinds, lambda c: 1.0 - F.length(F.replace(text, c, F.lit(""))) / F.length(text))
    bits = F.aggregate(shares, F.lit(0.0), lambda sum_, p: sum_ - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(F.length(text) > 0, bits).otherwise(0.0)


def suffix() -> Column:
    """Last two labels of the host; the whole host if it has fewer."""
    return F.substring_index("host", ".", -2)


LEXICAL = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "labels", "hyphens", "fragment", "suffix_share", "suffix_blocked")


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Add the lexical features of a row with url, host, path, query."""
    whole = F.coalesce(F.col(url), F.lit(""))
    size = F.length(whole)
    return df.withColumns(
        {
            "url_length": size.cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": count_of(F.col("path"), "[^/]+"),
            "digit_ratio": F.when(size > 0, count_of(whole, "[0-9]") / size).otherwise(0.0),
            "entropy": entropy(lower_ascii(F.concat("host", "path"))),
            "parameters": count_of(F.col("query"), "[^&]+"),
            "labels": count_of(F.col("host"), "[^.]+"),
            "hyphens": count_of(F.col("host"), "-"),
            "fragment": F.when(whole.contains("#"), 1.0).otherwise(0.0),
        }
    )


def addresses(rows: DataFrame) -> DataFrame:
    """The different URLs of ``rows`` with host, path, query and given verdict, all of which follow from the URL."""
    return rows.groupBy("url").agg(*(F.first(name).alias(name) for name in ("host", "path", "query", "given")))


def label_of(given: Column) -> Column:
    """1 for block, 0 for allow, null for no verdict."""
    return F.when(given.isNotNull(), (given == "block").cast("double"))


def with_suffix_statistics(rows: DataFrame, urls: DataFrame) -> DataFrame:
    """Add how common the suffix is and the smoothed share of blocked ones among its labelled URLs.

    Both count the different URLs of ``urls`` once, however often a row has them. A URL's own label takes no
    part in its statistics: what the trees learn from labelled URLs would not hold for others.
    """
    label = label_of(F.col("given"))
    each = urls.groupBy(suffix().alias("_suffix")).agg(F.count(F.lit(1)).alias("_n"), F.count(label).alias("_known"), F.sum(label).alias("_blocked"))
    each = stage(each, "suffixes")
    whole = each.agg(F.sum("_n").alias("n"), F.sum("_known").alias("known"), F.sum("_blocked").alias("blocked"), F.count(F.lit(1)).alias("suffixes")).first()
    base = (whole.blocked or 0) / whole.known if whole.known else 0.5
    statistics = each.select("_suffix", F.log(F.col("_n") / F.lit(float(max(1, whole.n or 1)))).alias("suffix_share"), "_known", F.coalesce("_blocked", F.lit(0.0)).alias("_blocked"))
    few = whole.suffixes <= BROADCAST_SUFFIXES
    joined = rows.withColumn("_suffix", suffix()).join(F.broadcast(statistics) if few else statistics, "_suffix")
    own = F.coalesce(label, F.lit(0.0))
    known = F.col("_known") - label.isNotNull().cast("int")
    return joined.withColumn("suffix_blocked", (F.col("_blocked") - own + PRIOR * base) / (known + PRIOR)).drop("_suffix", "_known", "_blocked")


def drawn(labelled: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``labelled`` different URLs with ``label`` and ``weight``: about half of ``rows`` of either label at most, picked by a hash.

    A label of fewer URLs gives all of them. A URL's weight is how many of its label it stands for.
    """
    labelled = labelled.withColumn("label", label_of(F.col("given")))
    kinds = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows
    shares = {row.label: min(1.0, rows / 2 / row.n) for row in kinds}
    by_label = lambda values: F.coalesce(*(F.when(F.col("label") == k, F.lit(v)) for k, v in values.items()), F.lit(0.0))
    picked = F.pmod(F.xxhash64("url"), F.lit(DRAWS)) < by_label({k: share * DRAWS for k, share in shares.items()})
    return labelled.where(picked).withColumn("weight", by_label({k: 1.0 / share for k, share in shares.items()}))


def train(sample: DataFrame):
    """GBT model of features, ``label`` and ``weight``; None if the labels are not of both kinds."""
    sample = stage(sample.select("label", "weight", *LEXICAL), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    features = VectorAssembler(inputCols=list(LEXICAL), outputCol="features").transform(sample)
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False)
    return trees.fit(features)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, fallback: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict and score (of the trees) for every row.

    The verdict is the longest fitting rule's, else the trees'; ``fallback`` where rules label no URL or all alike,
    so that there is nothing to learn. Each label has its own share of the trees' sample, so a rare one is learned.
    Repeated rows are judged each and learned once. An empty table gives an empty result.
    """
    rows = with_parts(pages.select("page_id", "url"))
    rows = stage(rows.withColumn("rule", matching_rule(rules)), "parts")  # its long expressions are not repeated below
    verdicts = F.coalesce(*(F.when(F.col("rule") == r.name, F.lit(r.verdict)) for r in rules), F.lit(None).cast("string"))
    rows = rows.withColumn("given", verdicts)
    urls = stage(addresses(rows), "addresses")
    model = train(with_features(with_suffix_statistics(drawn(urls.where("given is not null")), urls)))
    rows = with_features(with_suffix_statistics(rows, urls))
    drop_stage(urls)
    if model is None:
        rows = rows.withColumns({"prediction": F.lit(float(fallback == "block")), "score": F.lit(None).cast("double")})
    else:
        from pyspark.ml.functions import vector_to_array

        rows = model.transform(VectorAssembler(inputCols=list(LEXICAL), outputCol="features").transform(rows))
        rows = rows.withColumn("score", vector_to_array("probability")[1])
    learned = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("given", learned).alias("verdict"), "score")
