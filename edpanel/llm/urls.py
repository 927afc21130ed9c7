"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the
URLs that no rule fits. DataFrame functions only.

1. A URL is cut into host, path and query; the longest fitting rule gives its verdict. URLs that a
   rule fits are the labelled ones.
2. Features are small integers: length, depth, host labels, digit ratio, entropy, parameter and
   hyphen counts, and suffix statistics: the share of blocked URLs among the labelled ones with the
   same last host label, last two labels, first path segment, and file suffix. Suffixes are hashed
   into ``BUCKETS`` buckets, so those tables stay small at any size of the input; shares are smoothed, and a
   labelled URL takes them from the folds of other hosts than its own.
3. Trees are grown on counts: all labelled URLs are aggregated to distinct rows of binned
   features (``BINS`` bins with edges at exact quantiles), and a level of a tree is one aggregate of gradients per
   (node, feature, bin). Gradients are fixed-point numbers, so sums do not depend on their order.
   The trees are literals of one margin expression.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule and is
judged by the trees on the text it has; without a labelled URL the verdict is ``allow``; of fitting rules with
equal length a blocking one wins; repeated rows count and are judged each; empty tables give no row; extra
columns stay and those that clash with result names are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edpanel.llm.common import written

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict)
RULES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK))
TREES, DEPTH, BINS, RATE = 10, 3, 16, 0.5
BUCKETS, FOLDS, SMOOTHING = 4096, 4, 16
LAMBDA, MIN_GAIN, FIXED = 1.0, 1e-3, 1 << 20
MOST = 4095  # largest feature code
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIXES = ("label", "domain", "segment", "extension")
NUMBERS = ("length", "depth", "labels", "digits", "entropy", "params", "hyphens")
FEATURES = NUMBERS + SUFFIXES


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_name(rule: tuple[str, str, str]) -> str:
    return rule[0] + rule[1]


def fitting(rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict over columns host and path; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(rule_name(r)), r[2] == BLOCK, r)):
        fits = ((F.col("host") == rule[0]) | F.endswith("host", F.lit("." + rule[0]))) & F.startswith("path", F.lit(rule[1]))
        name, verdict = F.when(fits, F.lit(rule_name(rule))).otherwise(name), F.when(fits, F.lit(rule[2])).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits per character: a fold over the sorted characters that closes a run at each change."""
    letters = F.array_sort(F.split(text, ""))
    total = F.length(text).cast("double")

    def closed(acc):
        return acc["sum"] + F.when(acc["run"] > 0, acc["run"] * F.log2(acc["run"] / total)).otherwise(0.0)

    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    folded = F.aggregate(letters, start, lambda acc, c: F.struct(
        c.alias("last"), F.when(c == acc["last"], acc["run"] + 1.0).otherwise(1.0).alias("run"),
        F.when(c == acc["last"], acc["sum"]).otherwise(closed(acc)).alias("sum")), closed)
    return F.when(F.length(text) > 0, -folded / total).otherwise(0.0)


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` with host, path, the numeric feature codes and one bucket per kind of suffix."""
    df = pages.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    url, length = F.coalesce("url", F.lit("")), F.length(F.coalesce("url", F.lit("")))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    codes = {"length": length, "depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")), "labels": F.size(F.split("host", r"\.")),
             "digits": F.floor(256 * _count(url, "0123456789") / F.greatest(length, F.lit(1))), "entropy": F.floor(entropy(url) * 256),
             "params": F.when(query != "", 1 + _count(query, "&")).otherwise(0), "hyphens": _count(url, "-_")}
    texts = {"label": F.element_at(F.split("host", r"\."), -1), "domain": F.regexp_extract("host", r"[^.]*(\.[^.]*)?$", 0),
             "segment": F.regexp_extract("path", r"^/([^/]*)/", 1), "extension": F.regexp_extract("path", r"(\.[^./]*)$", 1)}
    return df.withColumns({f"_{k}": F.least(c, F.lit(MOST)).cast("int") for k, c in codes.items()}
                          | {f"_{k}": F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int") for k, c in texts.items()}
                          | {"_fold": F.pmod(F.xxhash64("host", F.lit("fold")), F.lit(FOLDS)).cast("int")})


@dataclass
class Model:
    """Base log-odds, bin edges per feature, trees as nested (feature, bin, left, right) tuples
    with leaf values, and the table of suffix shares (kind, bucket, fold, share)."""
    base: float
    edges: dict[str, list[int]]
    shares: DataFrame
    trees: list = field(default_factory=list)


def suffix_shares(labelled: DataFrame) -> DataFrame:
    """(kind, bucket, fold, share code): blocked share of the labelled URLs outside the fold; of
    all of them for fold -1. At most kinds x BUCKETS x (FOLDS + 1) rows."""
    each = labelled.select("_fold", "blocked", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"_{k}").alias("bucket")) for k in SUFFIXES))).alias("s"))
    counts = each.groupBy("s.kind", "s.bucket", "_fold").agg(F.count("*").alias("n"), F.sum("blocked").alias("b"))
    bucket = Window.partitionBy("kind", "bucket")
    sums = counts.groupBy("kind", "bucket").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.map_from_entries(
        F.collect_list(F.struct("_fold", F.struct("n", "b")))).alias("own"))
    every = F.sum("n").over(Window.partitionBy("kind")), F.sum("b").over(Window.partitionBy("kind"))
    parts = sums.withColumns({"all_n": every[0], "all_b": every[1]}).withColumn("fold", F.explode(F.sequence(F.lit(-1), F.lit(FOLDS - 1))))
    own = F.try_element_at("own", F.col("fold"))
    n, b = F.col("n") - F.coalesce(own["n"], F.lit(0)), F.col("b") - F.coalesce(own["b"], F.lit(0))
    share = (b + SMOOTHING * F.col("all_b") / F.col("all_n")) / (n + SMOOTHING)
    return parts.select("kind", "bucket", "fold", F.floor(share * MOST).cast("int").alias("share"), F.floor(MOST * F.col("all_b") / F.col("all_n")).cast("int").alias("prior"))


def with_shares(df: DataFrame, shares: DataFrame, fold: Column) -> DataFrame:
    """Replace each suffix bucket of ``df`` by its share code; an unseen one gets the prior. The
    share tables are bounded by BUCKETS x (FOLDS + 1) rows each, so they are broadcast."""
    df = df.withColumn("_use", fold)
    for kind in SUFFIXES:
        table = shares.where(F.col("kind") == kind).select(F.col("bucket").alias(f"_{kind}"), F.col("fold").alias("_use"), F.col("share").alias("_share"))
        df = df.join(F.broadcast(table), [f"_{kind}", "_use"], "left").withColumn(f"_{kind}", F.coalesce("_share", F.lit(-1))).drop("_share")
    return df.drop("_use")


def quantile_edges(rows: DataFrame) -> dict[str, list[int]]:
    """Exact quantiles of each feature's codes (at most BINS - 1 edges); a bin ends at its edge."""
    codes = rows.select(F.explode(F.array(*(F.struct(F.lit(k).alias("f"), F.col(f"_{k}").alias("v")) for k in FEATURES))).alias("s"))
    counts = codes.groupBy("s.f", "s.v").agg(F.count("*").alias("n"))
    feature = Window.partitionBy("f")  # at most MOST + 2 values
    run = F.sum("n").over(feature.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select("f", "v", F.expr(f"({BINS} * 1)").alias("bins"), (F.lit(BINS) * (run - F.col("n"))).alias("lo"),
                           (F.lit(BINS) * run).alias("hi"), F.sum("n").over(feature).alias("all"))
    cut = ranked.where(F.expr("lo div all < hi div all AND hi < bins * all"))
    out: dict[str, list[int]] = {k: [] for k in FEATURES}
    for r in cut.select("f", "v").collect():  # BINS - 1 rows a feature at most
        out[r.f].append(r.v)
    return {k: sorted(v) for k, v in out.items()}


def binned(edges: dict[str, list[int]]) -> list[Column]:
    def bin_of(k: str) -> Column:
        out = F.lit(len(edges[k]))
        for i in range(len(edges[k]) - 1, -1, -1):
            out = F.when(F.col(f"_{k}") <= edges[k][i], F.lit(i)).otherwise(out)
        return out.cast("int").alias(f"b_{k}")
    return [bin_of(k) for k in FEATURES]


def tree_value(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, cut, left, right = tree
    return F.when(F.col(f"b_{feature}") <= cut, tree_value(left)).otherwise(tree_value(right))


def margin(base: float, trees: list) -> Column:
    return sum((tree_value(t) for t in trees), F.lit(float(base)))


def best_split(cells: list[tuple[str, int, int, int]]) -> tuple[float, str, int] | None:
    """Best (gain, feature, bin) of one node's (feature, bin, gradient, hessian) sums; ties to
    the first feature and the lowest bin."""
    by_feature: dict[str, dict[int, tuple[int, int]]] = {}
    for f, b, g, h in cells:
        by_feature.setdefault(f, {})[b] = (g, h)
    best = None
    for f in FEATURES:
        bins = sorted(by_feature.get(f, {}).items())
        all_g, all_h = sum(v[0] for _, v in bins), sum(v[1] for _, v in bins)
        g = h = 0
        for b, (dg, dh) in bins[:-1]:
            g, h = g + dg, h + dh
            gain = (_score(g, h) + _score(all_g - g, all_h - h) - _score(all_g, all_h))
            if gain > MIN_GAIN and (best is None or gain > best[0]):
                best = gain, f, b
    return best


def _score(g: int, h: int) -> float:
    return (g / FIXED) ** 2 / (h / FIXED + LAMBDA)


def _leaf(g: int, h: int) -> float:
    return -RATE * (g / FIXED) / (h / FIXED + LAMBDA)


def grow_tree(rows: DataFrame, base: float, trees: list, depth: int = DEPTH):
    """One tree on rows (b_<feature>, n, blocked) under the margin of the trees so far: one aggregate a level."""
    p = 1 / (1 + F.exp(-margin(base, trees)))
    graded = rows.withColumns({"g": F.round((F.col("n") * p - F.col("blocked")) * FIXED).cast("long"),
                               "h": F.round(F.col("n") * p * (1 - p) * FIXED).cast("long")})
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("f"), F.col(f"b_{k}").alias("b")) for k in FEATURES))).alias("s")
    splits: dict[int, tuple] = {}
    totals: dict[int, tuple[int, int]] = {}
    open_nodes, node = {1}, F.lit(1)
    for level in range(depth):
        sums = (graded.withColumn("node", node).where(F.col("node").isin(*open_nodes)).select("node", "g", "h", cells)
                .groupBy("node", "s.f", "s.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
        parts: dict[int, list] = {}
        for r in sums:  # 2 ** level nodes x features x BINS rows at most
            parts.setdefault(r.node, []).append((r.f, r.b, r.g, r.h))
        following = set()
        for k, part in parts.items():
            first = [(b, g, h) for f, b, g, h in part if f == FEATURES[0]]
            totals[k] = sum(g for _, g, _ in first), sum(h for _, _, h in first)
            found = best_split(part)
            if found:
                _, f, cut = splits[k] = found
                for child, side in ((2 * k, lambda b: b <= cut), (2 * k + 1, lambda b: b > cut)):
                    totals[child] = tuple(sum(c[i] for c in part if c[0] == f and side(c[1])) for i in (2, 3))
                following |= {2 * k, 2 * k + 1}
        if not following:
            break
        open_nodes, here = following, node
        for k, (_, f, cut) in splits.items():
            if 2 * k in following:
                node = F.when(here == k, F.when(F.col(f"b_{f}") <= cut, 2 * k).otherwise(2 * k + 1)).otherwise(node)

    def build(k: int):
        return (splits[k][1], splits[k][2], build(2 * k), build(2 * k + 1)) if k in splits else _leaf(*totals.get(k, (0, 0)))

    return build(1)


def fit(labelled: DataFrame, trees: int = TREES) -> Model | None:
    """Boosted trees on all of ``labelled`` (the columns of :func:`lexical` and blocked, 0 or 1); none without rows."""
    names = [f"_{k}" for k in FEATURES]
    shares = written(suffix_shares(labelled), "shares")
    rows = written(with_shares(labelled.select("blocked", "_fold", *names), shares, F.col("_fold")).select("blocked", *names), "labelled")
    n, b = rows.agg(F.count("*"), F.sum("blocked")).first()
    if not n:
        return None
    prior = shares.agg(F.max("prior")).first()[0]
    rows = rows.withColumns({f"_{k}": F.when(F.col(f"_{k}") < 0, prior).otherwise(F.col(f"_{k}")) for k in SUFFIXES})
    edges = quantile_edges(rows)
    bins = [f"b_{k}" for k in FEATURES]
    counted = written(rows.select("blocked", *binned(edges)).groupBy(*bins).agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked")), "binned")
    model = Model(math.log((b + 1) / (n - b + 1)), edges, shares)
    for _ in range(trees):
        model.trees.append(grow_tree(counted, model.base, model.trees))
    return model


def predict(df: DataFrame, model: Model | None) -> DataFrame:
    """``df`` (the columns of :func:`lexical`) with ``margin``, the log-odds of blocking."""
    if model is None:
        return df.withColumn("margin", F.lit(-1.0))
    prior = model.shares.agg(F.max("prior")).first()[0]
    df = with_shares(df, model.shares, F.lit(-1))
    df = df.withColumns({f"_{k}": F.when(F.col(f"_{k}") < 0, prior).otherwise(F.col(f"_{k}")) for k in SUFFIXES})
    return df.select("*", *binned(model.edges)).withColumn("margin", margin(model.base, model.trees)).drop(*(f"b_{k}" for k in FEATURES))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and margin. The trees learn from the URLs that a rule fits."""
    pages = pages.drop("host", "path", "rule", "verdict", "margin", "blocked", *(f"_{k}" for k in (*FEATURES, "fold", "use")))
    name, verdict = fitting(rules)
    df = lexical(pages)
    keep = ["_fold", *(f"_{k}" for k in FEATURES)]
    labelled = df.withColumn("_verdict", verdict).where("_verdict is not null").select((F.col("_verdict") == BLOCK).cast("int").alias("blocked"), *keep)
    judged = predict(df, fit(written(labelled, "features"))).withColumns({"rule": name, "_verdict": verdict})
    learned = F.when(F.col("margin") > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.withColumn("verdict", F.coalesce("_verdict", learned)).drop("_verdict", *keep)
