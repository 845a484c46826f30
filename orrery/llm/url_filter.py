"""URL verdicts: rules first, then gradient-boosted trees on lexical features.

URLs that a rule decides are the labelled ones; the trees learn from them what blocked and allowed URLs look
like and judge the rest. Suffix statistics say how common the host is, and what stands in front of the same
suffix (the host without its first label): the share of all URLs, the number of hosts, their mean path depth
and mean share of digits. They come from all rows, and no verdict enters them: a mean verdict by suffix would
tell the trees the label of the row itself. The trees are fitted on ``SAMPLE`` labelled rows at most, drawn by
hash; they are the only part that sees a sample.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm import urls
from orrery.llm.common import free_name, settled, table
from orrery.llm.quality import let

#: (verdict, host and path); the path begins with the slash.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SAMPLE = 20_000
TREES = 10
DEPTH = 3
FEATURES = ("length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "host_length", "host_share", "suffix_share", "suffix_hosts", "suffix_depth", "suffix_digits")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits the host (or a parent domain) and the start of the path; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""

    def of(chars: Column) -> Column:
        n = F.size(chars)
        counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
        return F.aggregate(counts, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))

    return F.when(F.length(text) > 0, let(F.split(text, ""), of)).otherwise(F.lit(0.0))


def suffix_of(host: Column) -> Column:
    """The host without its first label; a host of one label is its own suffix."""
    return F.when(F.contains(host, F.lit(".")), F.regexp_replace(host, r"^[^.]*\.", "")).otherwise(host)


def _lexical(df: DataFrame, url: Column) -> DataFrame:
    """Adds the features that need one row only, and the host's suffix."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    query = urls.query(text)
    labels = F.split("host_", r"\.")
    return df.withColumns({
        "length": F.length(text).cast("double"),
        "depth": (F.length("path_") - F.length(F.translate("path_", "/", ""))).cast("double"),
        "digit_ratio": (F.length(text) - F.length(F.translate(text, "0123456789", ""))) / n,
        "entropy": _entropy(text),
        "n_params": F.when(query == "", 0.0).otherwise((F.length(query) - F.length(F.translate(query, "&", "")) + 1).cast("double")),
        "n_labels": F.size(labels).cast("double"),
        "host_length": F.length("host_").cast("double"),
        "suffix": suffix_of(F.col("host_")),
    })


def featured(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """A struct ``row_`` of the columns of ``pages``, url_, host_, path_, rule_, suffix and the columns of ``FEATURES``."""
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row_"), F.col(f"`{url_col}`").cast("string").alias("url_"))
    base = base.withColumns({"host_": urls.host(F.col("url_")), "path_": urls.path(F.col("url_"))})
    base = _lexical(base.withColumn("rule_", rule_of(F.col("host_"), F.col("path_"), rules)), F.col("url_"))
    # One row per host, then one per suffix: a hot one is folded inside the tasks.
    hosts = settled(base.groupBy("suffix", "host_").agg(F.count("*").alias("n"), F.sum("depth").alias("depths"), F.sum(F.floor(F.col("digit_ratio") * 1000)).alias("digits")))
    total = max(hosts.agg(F.sum("n")).first()[0] or 0, 1)
    by_host = hosts.select("host_", (F.col("n") / total).alias("host_share"))
    n = F.sum("n")
    by_suffix = hosts.groupBy("suffix").agg((n / total).alias("suffix_share"), F.count("*").cast("double").alias("suffix_hosts"), (F.sum("depths") / n).alias("suffix_depth"), (F.sum("digits") / n).alias("suffix_digits"))
    # One row per key on the right; a hot host is a skewed key that AQE splits.
    return base.join(by_host, "host_").join(by_suffix, "suffix")


def fit(labelled: DataFrame, sample: int = SAMPLE) -> GBTClassificationModel | str:
    """Trees from rows with rule_ and features; a single verdict if only that one occurs, allow if none does."""
    counts = dict(labelled.groupBy("rule_.verdict").count().collect())  # two rows
    if len(counts) < 2:
        return next(iter(counts), "allow")
    share = min(1.0, sample / sum(counts.values()))
    # Distinct URLs are drawn by hash, so copies weigh no more than one row, and the draw does not depend on the order of rows.
    drawn = labelled.where(F.pmod(F.xxhash64("url_", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = drawn.select(*FEATURES, (F.col("rule_.verdict") == "block").cast("double").alias("label")).dropDuplicates()
    points = settled(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(drawn).select("features", "label").orderBy(*[F.xxhash64("label", F.col("features").cast("string"))]).coalesce(2))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, maxBins=32).fit(points)


def judged(pages: DataFrame, url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (probability of block by the trees; null where a rule decides).

    A null url, or one without ``://``, has an empty host and path, fits no rule and is judged by its
    features. Rows stay as they are, repeated ones too. Columns of ``pages`` keep their names and values; a new
    one whose name is taken gets an underscore. An empty table gives an empty result.
    """
    rows = featured(pages, url_col, rules)
    model = fit(rows.where("rule_ is not null"), sample)
    if isinstance(model, str):
        scored = rows.withColumn("score_", F.lit(1.0 if model == "block" else 0.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows))
        scored = scored.withColumn("score_", F.get(vector_to_array("probability"), F.lit(1)))
    by_trees = F.when(F.col("score_") > 0.5, "block").otherwise("allow")
    new = {"host": F.col("host_"), "path": F.col("path_"), "rule": F.col("rule_.rule"), "verdict": F.coalesce("rule_.verdict", by_trees), "score": F.when(F.col("rule_").isNull(), F.col("score_"))}
    return scored.select("row_.*", *[c.alias(free_name(pages, n)) for n, c in new.items()])


def op7(spark, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict")
