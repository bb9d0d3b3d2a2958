"""URL filters: block and allow rules, and gradient-boosted trees on lexical features for all other URLs.

Features are DataFrame expressions, the same for training and scoring; the trees are trained on a bounded sample of
labelled URLs on the driver and come back as one expression, so scoring is map-only and runs no Python.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, let, table

#: rule (host/path) -> verdict. A rule holds for its host and all subdomains where the url's path starts with its path.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Labelled URLs that the trees are trained on at most: those of the least hash.
SAMPLE = 20_000
#: Seed labels: a host with one of these words among its parts counts as unwanted in training.
UNWANTED = frozenset("ads adult bet casino cheap click farm loan pills porn promo replica seo spam track tracker viagra win xxx".split())
BLOCK_FROM = 0.5


def parts(url: Column) -> dict[str, Column]:
    """host, path and query of url; all empty where it is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return {
        "host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        "params": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1),
    }


def ruled(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, else null."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        own, _, under = rule.partition("/")
        fits.append(F.when(((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{under}"), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _entropy(text: Column) -> Column:
    """Bits for a character of text; 0 for an empty one."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    of = lambda a: F.aggregate(F.transform(F.array_distinct(a), lambda x: F.size(F.filter(a, lambda y: y == x)).cast("double")), F.lit(0.0), lambda s, c: s + c * F.log2(c), lambda s: F.log2(F.size(a).cast("double")) - s / F.size(a))
    return F.when(F.length(text) > 0, F.round(let(chars, of), 6)).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


#: in this order; suffix_rate is added from the training labels
FEATURES = ("url_length", "host_length", "labels", "longest_label", "depth", "digit_ratio", "host_digits", "hyphens", "entropy", "path_entropy", "param_count", "secure")


def features(url: Column) -> dict[str, Column]:
    """FEATURES from the columns host, path and params and the url itself."""
    u, host = F.coalesce(url, F.lit("")), F.col("host")
    return {
        "url_length": F.length(u).cast("double"),
        "host_length": F.length(host).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), lambda x: F.length(x))).cast("double"),
        "depth": _count(F.col("path"), "/[^/]"),
        "digit_ratio": F.round(_count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1)), 6),
        "host_digits": _count(host, "[0-9]"),
        "hyphens": _count(host, "-"),
        "entropy": _entropy(host),
        "path_entropy": _entropy(F.col("path")),
        "param_count": _count(F.col("params"), "[^&]+"),
        "secure": u.startswith("https://").cast("double"),
    }


@dataclass
class Tree:
    """A leaf if feature is None; else left holds rows with feature <= bound."""

    value: float = 0.0
    feature: int | None = None
    bound: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def values(self, x: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.bound, self.left.values(x), self.right.values(x))

    def expression(self, columns: list[str]) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(F.col(columns[self.feature]) <= self.bound, self.left.expression(columns)).otherwise(self.right.expression(columns))


@dataclass
class Model:
    start: float
    trees: list[Tree]
    suffixes: dict[str, float]  # suffix -> share of unwanted URLs, drawn towards the share of all
    other: float  # that of suffixes not seen in training

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum(t.values(x) for t in self.trees)

    def suffix_rate(self, host: Column) -> Column:
        """Looked up in one constant, in short maps by the checksum of the suffix, as maps are searched one by one."""
        if not self.suffixes:
            return F.lit(self.other)
        maps: list[dict[str, float]] = [{} for _ in range(len(self.suffixes) // 4 + 1)]
        for s, rate in sorted(self.suffixes.items()):
            maps[crc32(s.encode()) % len(maps)][s] = rate
        known = F.from_json(F.lit(json.dumps(maps)), "array<map<string,double>>")
        own = F.get(known, F.pmod(F.crc32(suffix(host).cast("binary")), F.lit(len(maps))).cast("int"))
        return F.coalesce(F.element_at(own, suffix(host)), F.lit(self.other))

    def probability(self) -> Column:
        """From the columns FEATURES and suffix_rate."""
        margin = reduce(lambda a, t: a + t.expression([*FEATURES, "suffix_rate"]), self.trees, F.lit(self.start))
        return F.round(1 / (1 + F.exp(-margin)), 6)


def _grown(x: np.ndarray, binned: np.ndarray, bounds: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, rate: float, ridge: float, least: int) -> Tree:
    total_g, total_h = g[rows].sum(), h[rows].sum()
    leaf = Tree(float(-rate * total_g / (total_h + ridge)))
    best = (1e-6, None, None)
    if depth:
        for f, own in enumerate(bounds):
            if not len(own):
                continue
            sums = [np.bincount(binned[rows, f], w, len(own) + 1).cumsum()[:-1] for w in (g[rows], h[rows], np.ones(len(rows)))]
            gain = sums[0] ** 2 / (sums[1] + ridge) + (total_g - sums[0]) ** 2 / (total_h - sums[1] + ridge) - total_g**2 / (total_h + ridge)
            gain[(sums[2] < least) | (len(rows) - sums[2] < least)] = -np.inf
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
    if best[1] is None:
        return leaf
    _, f, k = best
    go = binned[rows, f] <= k
    sides = (_grown(x, binned, bounds, g, h, part, depth - 1, rate, ridge, least) for part in (rows[go], rows[~go]))
    return Tree(0.0, f, float(bounds[f][k]), *sides)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0, bins: int = 32, least: int = 5) -> tuple[float, list[Tree]]:
    """Second-order boosting of the logistic loss over histograms. Returns the starting margin and the trees."""
    share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return start, []
    bounds = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1]))[: bins - 1] for c in x.T]
    binned = np.stack([np.searchsorted(b, c, "left") for b, c in zip(bounds, x.T)], 1)
    margin, made = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        made.append(_grown(x, binned, bounds, p - y, p * (1 - p), np.arange(len(y)), depth, rate, ridge, least))
        margin = margin + made[-1].values(x)
    return start, made


def train(labelled: DataFrame, url: str = "url", label: str = "label", sample: int = SAMPLE) -> Model:
    """Trees for labelled (url, label: 1 unwanted, 0 wanted), from at most `sample` rows; only their features come to
    the driver. The rates of all their suffixes are kept. Rows without url or label are left out; without both labels
    the model gives the labels' share."""
    chosen = labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("y")).where("url IS NOT NULL AND y IS NOT NULL").orderBy(F.xxhash64("url"), "url", "y").limit(sample)
    rows = chosen.withColumns(parts(F.col("url"))).withColumns(features(F.col("url")) | {"suffix": suffix(F.col("host"))}).select(*FEATURES, "suffix", "y").toPandas()
    y = rows["y"].to_numpy()
    mean = float(y.mean()) if len(y) else 0.0
    stats = rows.groupby("suffix")["y"].agg(["sum", "count"])
    rates = {s: round(float((r["sum"] + 20 * mean) / (r["count"] + 20)), 6) for s, r in stats.iterrows()}
    x = np.column_stack([rows[list(FEATURES)].to_numpy(float), rows["suffix"].map(rates).fillna(mean).to_numpy(float)]) if len(rows) else np.zeros((0, len(FEATURES) + 1))
    return Model(*fit(x, y), rates, round(mean, 6))


def judge(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", rules: dict[str, str] = RULES, block_from: float = BLOCK_FROM) -> DataFrame:
    """A row for each row of pages: its id, host, path, rule (the longest that fits, else null), probability (of being
    unwanted), verdict (allow or block: the rule's, else the trees').

    Null urls and urls without :// have an empty host and path, and no rule; the trees judge them by their features.
    Whole urls are read; repeated rows give a row each; other columns are ignored. Map-only.
    """
    p = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"))
    p = p.withColumns(parts(F.col("url")))
    p = p.withColumns(features(F.col("url")) | {"suffix_rate": model.suffix_rate(F.col("host")), "rule": ruled(F.col("host"), F.col("path"), rules)})
    verdicts = reduce(lambda w, kv: w.when(F.col("rule") == kv[0], kv[1]), list(rules.items())[1:], F.when(F.col("rule") == next(iter(rules)), rules[next(iter(rules))])) if rules else F.when(F.lit(False), "")
    p = p.withColumn("probability", model.probability())
    return p.select(F.col("id").alias(page_id), "host", "path", "rule", verdicts.otherwise(F.when(F.col("probability") >= block_from, "block").otherwise("allow")).alias("verdict"), "probability")


def seed_labels(pages: DataFrame, url: str = "url") -> DataFrame:
    """(url, label) of pages by the words of their hosts; urls without a host are left out."""
    p = pages.select(F.col(url).alias("url")).withColumns(parts(F.col("url"))).where("host <> ''")
    return p.select("url", F.arrays_overlap(F.split("host", r"[.-]"), F.array(*map(F.lit, sorted(UNWANTED)))).cast("int").alias("label"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, train(seed_labels(pages)))


def rules_query(spark, sf_dir: str) -> DataFrame:
    """What SQL can express of the above: host, path and rule, and the verdict of the rule, null without one."""
    verdicts = F.create_map(*(F.lit(x) for kv in RULES.items() for x in kv))
    return query(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule"))).alias("ruled"))


RULES_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule, own, under, ruled) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
f AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(ruled, length(rule)) AS ruled FROM p JOIN r ON (host = own OR suffix(host, '.' || own)) AND starts_with(path, under) GROUP BY page_id)
SELECT page_id, host, path, rule, ruled FROM p LEFT JOIN f USING (page_id)
"""
