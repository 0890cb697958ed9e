"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import ascii_lower, bounded_sample, kept

# (verdict, host, path): fits the host and its subdomains where the path starts with the rule's.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MAX_RULES = 1000

# Labelled URLs per class that the trees are fitted on, at most.
SAMPLE_ROWS = 10_000
TREES, DEPTH = 20, 4
# Suffix statistics are kept per hashed suffix, so their table has a fixed size.
SUFFIX_CELLS = 1024
PRIOR_ROWS = 4.0

LEXICAL = (
    "url_length host_length path_length query_length depth labels digit_ratio host_digit_ratio "
    "letter_ratio entropy parameters hyphens escapes fragment https"
).split()
FEATURES = [*LEXICAL, "suffix_odds", "domain_odds"]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or a URL."""
    form = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    return (
        ascii_lower(F.coalesce(F.regexp_extract(url, form, 1), F.lit(""))),
        F.coalesce(F.regexp_extract(url, form, 2), F.lit("")),
    )


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or NULL."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    fits = []
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        here = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        fits.append(F.when(here, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def count_of(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that belong to a character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text."""
    size = F.length(text).cast("double")

    def add(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return total - share * F.log2(share)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.when(size > 0, F.aggregate(chars, F.lit(0.0), add)).otherwise(F.lit(0.0))


def with_features(df: DataFrame) -> DataFrame:
    """Lexical features of _url, host, path, and the hashed suffix cells."""
    url, host, path = F.col("_url"), F.col("host"), F.col("path")
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    features = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "query_length": F.length(query),
        "depth": count_of(path, "[^/]"),
        "labels": F.size(labels),
        "digit_ratio": count_of(url, "[0-9]") / size,
        "host_digit_ratio": count_of(host, "[0-9]") / F.greatest(F.length(host), F.lit(1)),
        "letter_ratio": count_of(url, "[A-Za-z]") / size,
        "entropy": entropy(url),
        "parameters": count_of(query, "="),
        "hyphens": count_of(host, "[-_]"),
        "escapes": count_of(url, "%"),
        "fragment": url.contains("#").cast("int"),
        "https": url.startswith("https://").cast("int"),
    }
    features["depth"] = F.length(path) - features["depth"]
    columns = {name: c.cast("double") for name, c in features.items()}
    suffix = F.substring_index(host, ".", -1)
    domain = F.substring_index(host, ".", -2)
    columns["_suffix"] = F.pmod(F.xxhash64(suffix, F.lit(1)), F.lit(SUFFIX_CELLS)).cast("int")
    columns["_domain"] = F.pmod(F.xxhash64(domain, F.lit(2)), F.lit(SUFFIX_CELLS)).cast("int")
    return df.withColumns(columns)


def odds(blocked: Column, rows: Column, share: float) -> Column:
    """Smoothed log odds of a block."""
    p = (blocked + F.lit(PRIOR_ROWS * share)) / (rows + F.lit(PRIOR_ROWS))
    return F.log(p / (F.lit(1.0) - p))


@dataclass
class UrlModel:
    """Fitted trees with their suffix tables, or one verdict for everything."""

    trees: GBTClassificationModel | None
    tables: dict[str, tuple[list[float], list[float]]]
    share: float
    only: str | None = None

    def with_odds(self, df: DataFrame, own: Column | None = None) -> DataFrame:
        """``own``: the row's label, taken out of the counts it is part of."""
        blocked_own, rows_own = (own, F.lit(1.0)) if own is not None else (F.lit(0.0), F.lit(0.0))
        columns = {}
        for name, cell in (("suffix_odds", "_suffix"), ("domain_odds", "_domain")):
            blocked, rows = (F.element_at(F.array(*map(F.lit, t)), F.col(cell) + 1) for t in self.tables[cell])
            columns[name] = odds(F.greatest(blocked - blocked_own, F.lit(0.0)), F.greatest(rows - rows_own, F.lit(0.0)), self.share)
        return df.withColumns(columns)

    def judge(self, df: DataFrame) -> DataFrame:
        """Adds score (chance of a block) and the method's verdict as _judged."""
        if self.trees is None:
            score = 1.0 if self.only == "block" else 0.0
            return df.withColumn("score", F.lit(score)).withColumn("_judged", F.lit(self.only))
        ready = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(self.with_odds(with_features(df)))
        scored = self.trees.transform(ready).withColumn("score", vector_to_array("_chance")[1])
        return scored.withColumn("_judged", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Train from _url, host, path, label (1.0: block, 0.0: allow).

    Suffix statistics cover all labelled rows; the trees see the ``sample_rows``
    rows of each class with the smallest hashes. Without rows of both classes
    the model has one verdict: the only class, or allow without any rows.
    """
    cells = with_features(labelled).select("_suffix", "_domain", "label")
    per_cell = (
        cells.select(F.explode(F.array(F.struct(F.lit("_suffix").alias("kind"), F.col("_suffix").alias("cell")), F.struct(F.lit("_domain").alias("kind"), F.col("_domain").alias("cell")))).alias("_at"), "label")
        .groupBy("_at.kind", "_at.cell")
        .agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )  # at most two rows per cell
    tables = {kind: ([0.0] * SUFFIX_CELLS, [0.0] * SUFFIX_CELLS) for kind in ("_suffix", "_domain")}
    for row in per_cell:
        tables[row["kind"]][0][row["cell"]] = float(row["blocked"])
        tables[row["kind"]][1][row["cell"]] = float(row["rows"])
    blocked, rows = sum(tables["_suffix"][0]), sum(tables["_suffix"][1])
    if blocked in (0.0, rows):
        return UrlModel(None, tables, 0.5, "block" if blocked else "allow")
    model = UrlModel(None, tables, blocked / rows)
    draw = [F.col("_url")] + [F.col(c) for c in ("page_id",) if c in labelled.columns]
    sample = None
    for label, total in ((0.0, rows - blocked), (1.0, blocked)):
        part = bounded_sample(labelled.filter(F.col("label") == label), sample_rows, draw, int(total))
        sample = part if sample is None else sample.unionByName(part)
    sample = kept(model.with_odds(with_features(sample), F.col("label")).select("label", *FEATURES), "url-sample")
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(sample)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, subsamplingRate=0.7, seed=17
    ).setProbabilityCol("_chance")
    model.trees = trees.fit(ready)
    return model


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, model: UrlModel | None = None) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url; other columns are ignored).

    The longest fitting rule decides; of equally long ones the first by host
    and path. Without a rule the trees decide. If no model is given, one is
    trained from the URLs that a rule labels. A NULL url, an empty one and one
    without ``://`` have an empty host and path and no rule. Repeated rows are
    judged alike. Result: page_id, host, path, rule, verdict, score.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("_url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    if model is None:
        known = rows.filter(F.col("_rule").isNotNull())
        model = fit(known.select("page_id", "_url", "host", "path", (F.col("_rule.verdict") == "block").cast("double").alias("label")))
    return model.judge(rows).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", "_judged").alias("verdict"), "score"
    )
