"""URL filter: listed rules, and gradient-boosted trees where no rule fits.

A rule is a host and the beginning of a path, ``org/`` or ``example.org/en/1``,
with a verdict, ``allow`` or ``block``. It fits a URL whose host is its host or
a subdomain and whose path starts with its path. The longest fitting rule decides
(of equally long ones that with the longer host). The URLs that rules decide are
the labelled ones; from them the trees learn to judge all others by lexical
features: lengths, depth, digit ratio, entropy, parameter counts, marks, and
statistics of host suffixes.

All steps are DataFrame operations and SQL functions. Features fall on fixed
grids, so that trees see whole numbers from 0 to ``BINS`` - 1 and labelled URLs
that look alike become one row with a count: training reads that stored table, as
many rows as there are different URLs to the trees, for every level of every
tree. A level's histograms (nodes x features x bins sums) come from one
aggregation, merged on the map side; the driver gets these sums, whose number is
fixed, and picks the splits. Gradients are whole numbers of 2**-16, so that sums
do not depend on the order of rows and each run gives the same trees. All
labelled URLs take part; there is no sample.

The share of blocked URLs among the labelled ones of a host's suffix (its last
label, its last two labels) is a feature as well. For a labelled URL it is taken
without its own fold, one of ``FOLDS`` by a hash of the URL, so that no URL sees
its own label, nor that of a copy.

Defined cases: a null URL, or one without ``://``, has an empty host and an empty
path, fits no rule and is judged by its features; without labelled URLs all
others are allowed; repeated rows are judged each; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.session import materialize, small_side

BINS = 32
TREES, DEPTH = 16, 3
RATE, RIDGE = 0.3, 1.0
# A split leaves at least this weight, a sum of p * (1 - p), on either side.
LEAST_WEIGHT = 1.0
FOLDS = 5
# Labelled URLs of the average kind that a suffix's share is mixed with.
PRIOR = 4
# Gradients are whole numbers of 1 / UNIT.
UNIT = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Shannon entropy of a URL's characters in bits: equal ones stand together, so that one pass counts them.
_ENTROPY = """
    CASE WHEN length(whole) = 0 THEN 0D ELSE aggregate(sort_array(split(whole, '')),
        named_struct('last', '', 'run', 0L, 'total', 0D),
        (s, c) -> CASE WHEN c = s.last THEN named_struct('last', s.last, 'run', s.run + 1, 'total', s.total)
            ELSE named_struct('last', c, 'run', 1L, 'total', s.total + CASE WHEN s.run > 1 THEN s.run * log2(s.run) ELSE 0D END) END,
        s -> log2(length(whole)) - (s.total + s.run * log2(s.run)) / length(whole)) END
"""


class Rule(NamedTuple):
    """A verdict and what it is for: a host, then the beginning of a path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].translate(str.maketrans(_UPPER, _LOWER))

    @property
    def path(self) -> str:
        return self.text[self.text.find("/") :] if "/" in self.text else ""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z as a-z, and the path; both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_rules(spark: SparkSession, urls: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """URLs (with ``host`` and ``path``) and the ``rule`` and ``ruled`` verdict that decide them, null if none does.

    Rules are a list that the caller holds, of literals. A host is looked up by
    its last k labels for each number k of labels that a rule's host has.
    """
    lists: dict[str, dict[str, str]] = {}
    for rule in rules:
        if rule.verdict not in ("allow", "block") or not rule.host:
            raise ValueError(f"not a rule: {rule}")
        if lists.setdefault(rule.host, {}).setdefault(rule.text, rule.verdict) != rule.verdict:
            raise ValueError(f"two verdicts for {rule.text}")
    kind = "array<struct<length:int,host_length:int,rule:string,verdict:string,path:string>>"
    fitting = F.array().cast(kind)
    for labels in sorted({host.count(".") + 1 for host in lists}):
        entries = [
            F.struct(
                F.lit(host).alias("_host"),
                F.array(
                    *[
                        F.struct(
                            F.lit(len(text)).alias("length"), F.lit(len(host)).alias("host_length"), F.lit(text).alias("rule"),
                            F.lit(verdict).alias("verdict"), F.lit(Rule(verdict, text).path).alias("path"),
                        )
                        for text, verdict in texts.items()
                    ]
                ).cast(kind).alias(f"_rules{labels}"),
            )
            for host, texts in lists.items()
            if host.count(".") + 1 == labels
        ]
        listed = spark.range(1).select(F.inline(F.array(*entries)))
        urls = urls.join(F.broadcast(listed), F.substring_index("host", ".", -labels) == F.col("_host"), "left").drop("_host")
        fitting = F.concat(fitting, F.coalesce(F.col(f"_rules{labels}"), F.array().cast(kind)))
    kept = [c for c in urls.columns if not c.startswith("_rules")]
    best = F.array_max(F.filter(fitting, lambda r: F.startswith(F.col("path"), r["path"])))
    return urls.withColumn("_best", best).select(*kept, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("ruled"))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _step(value: Column, width: float) -> Column:
    """A number on a grid of ``BINS`` steps; the last takes all larger ones."""
    return F.least(F.floor(value / F.lit(float(width))), F.lit(BINS - 1)).cast("int")


def _lexical() -> dict[str, Column]:
    """Features from ``whole`` (the URL), ``host`` and ``path`` alone."""
    whole, host, path = F.col("whole"), F.col("host"), F.col("path")
    query = F.regexp_extract(whole, r"^[^?#]*\?([^#]*)", 1)
    length = F.length(whole)
    return {
        "url_length": _step(length, 4),
        "host_length": _step(F.length(host), 2),
        "path_length": _step(F.length(path), 2),
        "query_length": _step(F.length(query), 4),
        "depth": _step(_count(path, "/"), 1),
        "digit_ratio": _step(F.coalesce(F.try_divide(_count(whole, "[0-9]"), length), F.lit(0.0)), 1 / BINS),
        "path_digits": _step(_count(path, "[0-9]"), 1),
        "host_digits": _step(_count(host, "[0-9]"), 1),
        "entropy": _step(F.expr(_ENTROPY), 0.25),
        "parameters": _step(_count(query, "[^&]+"), 1),
        "labels": _step(_count(host, "[^.]+"), 1),
        "hyphens": _step(_count(host, "-"), 1),
        "escapes": _step(_count(whole, "%"), 1),
        "secure": whole.rlike("^(?i)https://").cast("int"),
        "fragment": F.contains(whole, F.lit("#")).cast("int"),
    }


LEXICAL = ("url_length", "host_length", "path_length", "query_length", "depth", "digit_ratio", "path_digits", "host_digits",
           "entropy", "parameters", "labels", "hyphens", "escapes", "secure", "fragment")
# Host suffixes of so many labels have statistics.
SUFFIXES = (1, 2)
FEATURES = (*LEXICAL, *(f"{what}_{k}" for k in SUFFIXES for what in ("share", "seen")))


def described(spark: SparkSession, urls: DataFrame, rules: Iterable[Rule], key: str, url: str) -> DataFrame:
    """Rows with ``host``, ``path``, ``rule``, ``ruled``, lexical features, host suffixes, ``label`` (1: blocked) and ``fold``."""
    host, path = host_and_path(F.col("whole"))
    split = urls.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias("whole"))
    split = with_rules(spark, split.withColumns({"host": host, "path": path}), rules)
    return split.select(
        "key", "host", "path", "rule", "ruled",
        (F.col("ruled") == "block").cast("int").alias("label"),
        (F.crc32("whole") % FOLDS).cast("int").alias("fold"),
        *[F.substring_index("host", ".", -k).alias(f"suffix_{k}") for k in SUFFIXES],
        *[feature.alias(name) for name, feature in _lexical().items()],
    )


def _with_suffixes(rows: DataFrame, labelled: DataFrame, blocked: int, total: int) -> DataFrame:
    """Rows with the statistics of their host's suffixes: share of blocked URLs, and how many there are."""
    mean = blocked / total if total else 0.0
    for k in SUFFIXES:
        name = f"suffix_{k}"
        by_fold = labelled.groupBy(name, "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("b"))
        # At most FOLDS entries per suffix.
        stats = by_fold.groupBy(F.col(name).alias("_suffix")).agg(
            F.sum("n").alias("_n"), F.sum("b").alias("_b"), F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "b")))).alias("_folds")
        )
        own = F.when(F.col("label").isNotNull(), F.element_at("_folds", F.col("fold")))
        seen = F.coalesce(F.col("_n"), F.lit(0)) - F.coalesce(own["n"], F.lit(0))
        share = F.coalesce(F.col("_b"), F.lit(0)) - F.coalesce(own["b"], F.lit(0)) + F.lit(PRIOR * mean)
        rows = (
            rows.join(small_side(stats), F.col(name) == F.col("_suffix"), "left")
            .withColumn(f"share_{k}", _step(share / (seen + F.lit(float(PRIOR))), 1 / BINS))
            .withColumn(f"seen_{k}", _step(F.log2(seen + F.lit(1.0)), 1))
            .drop("_suffix", "_n", "_b", "_folds")
        )
    return rows


class Node(NamedTuple):
    """A split (feature, last bin of the left side, both sides), or a leaf's value."""

    feature: str = ""
    last: int = 0
    left: Node | None = None
    right: Node | None = None
    value: float = 0.0

    def sql(self) -> str:
        if self.left is None or self.right is None:
            return f"{self.value!r}D"
        return f"CASE WHEN {self.feature} <= {self.last} THEN {self.left.sql()} ELSE {self.right.sql()} END"


class Split(NamedTuple):
    gain: float
    feature: int
    last: int
    left: tuple[int, int]
    right: tuple[int, int]


def best_split(bins: dict[tuple[int, int], tuple[int, int]], features: int) -> Split | None:
    """The split of a node with the highest gain, from its sums of gradients and weights by feature and bin."""
    best = None
    for feature in range(features):
        sums = [bins.get((feature, b), (0, 0)) for b in range(BINS)]
        all_g, all_h = (sum(x) for x in zip(*sums, strict=True))
        g = h = 0
        for last, (more_g, more_h) in enumerate(sums[:-1]):
            g, h = g + more_g, h + more_h
            if min(h, all_h - h) < LEAST_WEIGHT * UNIT:
                continue
            gain = _gain(g, h) + _gain(all_g - g, all_h - h) - _gain(all_g, all_h)
            if gain > (best.gain if best else 1e-9):
                best = Split(gain, feature, last, (g, h), (all_g - g, all_h - h))
    return best


def _gain(g: int, h: int) -> float:
    return (g / UNIT) ** 2 / (h / UNIT + RIDGE)


def _leaf(sums: tuple[int, int]) -> Node:
    return Node(value=-RATE * (sums[0] / UNIT) / (sums[1] / UNIT + RIDGE))


def _pulled(rows: DataFrame, score: Column, features: Sequence[str]) -> DataFrame:
    """Stored rows of features with their score, and the sums of gradients ``g`` and weights ``h`` of their URLs."""
    p, unit = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score"))), F.lit(UNIT)
    return materialize(
        rows.select(*features, "n", "b", score.alias("score")).select(
            "*",
            (F.col("n") * F.round(p * unit).cast("long") - F.col("b") * unit).alias("g"),
            (F.col("n") * F.round(p * (1 - p) * unit).cast("long")).alias("h"),
        )
    )


def _grown(rows: DataFrame, features: Sequence[str]) -> Node | None:
    """One more tree; None if no split gains anything."""
    # Places in the tree: 1 is the root, 2k and 2k + 1 are the sides of k.
    splits: dict[int, Split] = {}

    def place(node: int) -> str:
        if node not in splits:
            return str(node)
        name, last = features[splits[node].feature], splits[node].last
        return f"CASE WHEN {name} <= {last} THEN {place(2 * node)} ELSE {place(2 * node + 1)} END"

    for level in range(DEPTH):
        bins: dict[int, dict[tuple[int, int], tuple[int, int]]] = {}
        found = (
            rows.withColumn("node", F.expr(place(1)))
            .where(F.col("node") >= 1 << level)
            .select("node", "g", "h", F.posexplode(F.array(*features)).alias("feature", "bin"))
            .groupBy("node", "feature", "bin")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            .collect()  # at most 2 ** level * features * BINS sums
        )
        for r in found:
            bins.setdefault(r["node"], {})[r["feature"], r["bin"]] = (r["g"], r["h"])
        made = {node: split for node, sums in bins.items() if (split := best_split(sums, len(features)))}
        if not made:
            break
        splits |= made
    if not splits:
        return None

    def node(k: int, sums: tuple[int, int]) -> Node:
        s = splits.get(k)
        return Node(features[s.feature], s.last, node(2 * k, s.left), node(2 * k + 1, s.right)) if s else _leaf(sums)

    return node(1, (0, 0))


def boosted(train: DataFrame, blocked: int, total: int, features: Sequence[str] = FEATURES) -> str:
    """The score (log odds of being blocked) as a SQL expression of the features.

    ``train`` holds different rows of features, how many URLs have them (``n``) and how many of these are blocked (``b``).
    """
    score = f"{math.log((blocked + 0.5) / (total - blocked + 0.5))!r}D"
    rows = _pulled(train, F.expr(score), features)
    for k in range(TREES):
        tree = _grown(rows, features)
        if tree is None:
            break
        score += f" + {tree.sql()}"
        if k + 1 < TREES:
            rows = _pulled(rows, F.col("score") + F.expr(tree.sql()), features)
    return score


def judge(urls: DataFrame, rules: Iterable[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: the key, ``host``, ``path``, ``rule`` and ``verdict``, and ``score``, the trees' probability of ``block``.

    Features are stored once; after that neither URLs nor rows are shuffled, but
    counts by suffix and by equal features. Runs a job per level of each tree.
    """
    spark = urls.sparkSession
    rows = materialize(described(spark, urls, rules, key, url))
    labelled = rows.where(F.col("label").isNotNull())
    total, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    rows = _with_suffixes(rows, labelled, blocked, total)
    score = "0D"
    if total:
        alike = rows.where(F.col("label").isNotNull()).groupBy(*FEATURES)
        score = boosted(alike.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("b")), blocked, total)
    method = F.when(F.expr(score) > 0, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"),
        F.expr(f"1D / (1D + exp(-({score})))").alias("score"),
    )
