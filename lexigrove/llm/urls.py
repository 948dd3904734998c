"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule is a host and the start of a path; it fits the host and its subdomains, and the longest rule decides. URLs that
a rule decides are the labelled ones from which the trees learn (at most ``SAMPLE``, those with the smallest hashes):
length, depth, digits, entropy, parameters, marks, and how often labelled URLs of other folds with the host's last label were blocked, with smoothing.

Defined results: a URL that is null or has no ``://`` has an empty host and path and fits no rule; every row gets a
row. If rules label no URL, or all alike, there is nothing to learn and the rest gets the commoner verdict, ``allow`` on a tie.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from lexigrove.llm.sampling import by_hash
from lexigrove.plans.runtime import broadcast_if_small, materialize

SAMPLE, TREES, DEPTH, SEED = 20_000, 20, 4, 7
ALLOW, BLOCK = "allow", "block"
#: How many URLs' worth of the overall share a suffix starts with.
SMOOTHING = 5.0
#: Labelled URLs are dealt to so many folds by a hash of the URL.
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, then ``/`` and the start of the path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1] if "/" in self.text else ""


def _lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    start = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return _lower(host), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the longest rule that fits, else null; of equally long ones the first."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, rule.text).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    kinds = F.array_distinct(F.split(text, ""))

    def bits(c: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
        return F.when(share > 0, -share * F.log2(share)).otherwise(0.0)

    return F.aggregate(F.transform(kinds, bits), F.lit(0.0), lambda a, b: a + b)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def share(text: Column, pattern: str) -> Column:
        return _count(text, pattern) / F.greatest(F.length(text), F.lit(1))

    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": _count(host, r"\."),
        "depth": _count(path, "/[^/]"),
        "host_digits": share(host, "[0-9]"),
        "path_digits": share(path, "[0-9]"),
        "hyphens": _count(host, "-"),
        "entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(1 + _count(query, "&")),
        "escapes": _count(url, "%[0-9A-Fa-f]{2}"),
        "fragment": F.instr(url, "#").cast("boolean").cast("double"),
        "secure": F.lower(url).startswith("https://").cast("double"),
        "ends_in_slash": path.endswith("/").cast("double"),
    }


def _suffix_counts(labelled: DataFrame, is_block: Column) -> DataFrame:
    """``(suffix, rows, blocks)``: labelled URLs and blocked ones in each fold, as arrays."""
    def by_fold(value: Column) -> Column:
        return F.array([F.sum(F.when(F.col("fold") == f, value).otherwise(0.0)) for f in range(FOLDS)])

    return labelled.groupBy("suffix").agg(by_fold(F.lit(1.0)).alias("rows"), by_fold(is_block).alias("blocks"))


def _suffix_share(prior: float) -> Column:
    """How often URLs of the suffix were blocked; a labelled URL looks at the other folds only, so its label never reaches it.

    Leaving out just the row itself would not do: two values a suffix, one for each label, give the label away.
    """
    def looked_at(name: str) -> Column:
        everything = F.aggregate(name, F.lit(0.0), lambda a, b: a + b)
        own = F.when(F.col("ruled").isNotNull(), F.get(name, "fold")).otherwise(0.0)
        return F.coalesce(everything - own, F.lit(0.0))

    return (looked_at("blocks") + SMOOTHING * prior) / (looked_at("rows") + SMOOTHING)


def judge(pages: DataFrame, rules: Sequence[Rule], *, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """``(page_id, host, path, rule, verdict, block_probability)``; the last is null where a rule decided. Runs jobs when called."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    verdict_of = F.lit(None).cast("string")
    for rule in rules:
        verdict_of = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(verdict_of)
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("ruled", verdict_of)
    suffix = F.regexp_extract("host", r"[^.]*$", 0)
    columns = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    known = materialize(rows.select("page_id", "host", "path", "rule", "ruled", suffix.alias("suffix"), F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int").alias("fold"),
                                    *(c.alias(n) for n, c in columns.items())))
    is_block = (F.col("ruled") == BLOCK).cast("double")
    labelled = known.filter(F.col("ruled").isNotNull())
    n, blocked = labelled.agg(F.count("*"), F.sum(is_block)).first()
    results = ("page_id", "host", "path", "rule")
    if not n or blocked in (0.0, float(n)):
        common = F.lit(BLOCK if n and blocked > n / 2 else ALLOW)
        return known.select(*results, F.coalesce("ruled", common).alias("verdict"), F.lit(None).cast("double").alias("block_probability"))
    prior = blocked / n
    statistics = _suffix_counts(labelled, is_block)
    statistics = broadcast_if_small(statistics)
    full = known.join(statistics, "suffix", "left").withColumn("suffix_blocked", _suffix_share(prior))
    names = [*columns, "suffix_blocked"]
    vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    sample = by_hash(full.filter(F.col("ruled").isNotNull()), "page_id", SAMPLE, n)
    sample = materialize(sample.select(*names, is_block.alias("label")))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(vectors.transform(sample).select("features", "label"))
    judged = model.transform(vectors.transform(full))
    chance = vector_to_array("probability")[1]
    said = F.when(chance >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(*results, F.coalesce("ruled", said).alias("verdict"),
                         F.when(F.col("ruled").isNull(), chance).alias("block_probability"))
