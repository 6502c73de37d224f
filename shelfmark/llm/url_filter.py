"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame expressions.  The trees are grown level by level: one
job sums gradients by node, feature and bin, at most a few thousand numbers, and
the best split of each node becomes part of a CASE expression.  Judging a URL is
then one expression over its own text and its suffix's statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import recorded, removed, stored, table
from shelfmark.llm.registry import query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# About so many labelled URLs, chosen by a hash, grow the trees.
TRAIN_URLS = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 10, 3, 16, 0.3, 1.0
_UNIT = float(1 << 20)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        same = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return same & F.startswith(path, F.lit(self.path))


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``host``, ``path``, and the text and verdict of the longest rule that fits."""
    out = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    by_length = sorted(rules, key=lambda r: (-len(r.text), r.text))
    host, path = F.col("host"), F.col("path")
    rule = F.coalesce(*[F.when(r.fits(host, path), F.lit(r.text)) for r in by_length], F.lit(None).cast("string"))
    ruled = F.coalesce(*[F.when(F.col("rule") == r.text, F.lit(r.verdict)) for r in by_length], F.lit(None).cast("string"))
    return out.withColumn("rule", rule).withColumn("ruled", ruled)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    shares = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size
    )
    return F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers that describe a URL's text."""
    text = F.coalesce(url, F.lit(""))
    after = F.regexp_extract(text, r"\?([^#]*)", 1)
    return {
        "f_length": F.length(text).cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_depth": _count(path, "/[^/]"),
        "f_labels": _count(host, r"\."),
        "f_hyphens": _count(host, "-"),
        "f_digits": _count(text, "[0-9]") / F.greatest(F.length(text), F.lit(1)),
        "f_path_digits": _count(path, "[0-9]"),
        "f_params": F.when(F.length(after) > 0, 1 + _count(after, "&")).otherwise(F.lit(0.0)),
        "f_entropy": entropy(text),
        "f_host_entropy": entropy(host),
    }


def suffix_of(host: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host, ".", -2)


def suffix_statistics(ruled: DataFrame) -> DataFrame:
    """``suffix, s_share, s_blocked``: how common a suffix is, and the blocked share of its labelled URLs."""
    blocked = F.sum(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0))
    labelled = F.count("ruled")
    counted = ruled.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(
        F.log2(F.count(F.lit(1)).cast("double")).alias("s_share"), ((blocked + 1) / (labelled + 2)).alias("s_blocked")
    )
    return stored(counted, "suffixes")


def with_features(ruled: DataFrame, suffixes: DataFrame) -> tuple[DataFrame, list[str]]:
    named = lexical(F.col("url"), F.col("host"), F.col("path"))
    out = ruled.withColumns(named).withColumn("suffix", suffix_of(F.col("host"))).join(suffixes, "suffix", "left").drop("suffix")
    return out, [*named, "s_share", "s_blocked"]


Split = tuple[str, float]


@dataclass
class Trees:
    """Complete trees in heap order; ``start`` is the margin before the first one."""

    start: float
    splits: list[list[Split | None]]
    leaves: list[list[float]]

    def node(self, tree: list[Split | None], depth: int) -> Column:
        """The heap index at ``depth`` as an expression."""

        def below(at: int, left: int) -> Column:
            if not left:
                return F.lit(at)
            if at >= len(tree) or tree[at] is None:
                return below(2 * at + 1, left - 1)
            name, cut = tree[at]
            return F.when(F.col(name) > cut, below(2 * at + 2, left - 1)).otherwise(below(2 * at + 1, left - 1))

        return below(0, depth)

    def leaf(self, k: int) -> Column:
        """The value that tree ``k`` adds."""
        leaves = self.leaves[k]
        place = self.node(self.splits[k], DEPTH) - (len(leaves) - 1)
        return F.element_at(F.array(*map(F.lit, leaves)), place + 1)

    def margin(self) -> Column:
        return sum((self.leaf(k) for k in range(len(self.splits))), F.lit(self.start))


def grow(labelled: DataFrame, names: list[str], trees: int = TREES) -> Trees:
    """Boost trees on ``labelled`` (features and ``y`` 0 or 1); of a bounded number of rows."""
    rows = stored(labelled.select("y", *names), "labelled")
    cuts = [k / BINS for k in range(1, BINS)]
    found = rows.agg(F.avg("y"), F.count(F.lit(1)), *[F.percentile_approx(n, cuts, 10_000) for n in names]).first()
    if not found[1]:
        return Trees(0.0, [], [])
    share = min(max(found[0], 0.001), 0.999)
    edges = [sorted(set(own)) for own in found[2:]]
    # A feature's bin is the number of edges below its value.
    binned = [sum((F.col(n) > e).cast("int") for e in own) + F.lit(0) for n, own in zip(names, edges)]
    bins = F.array(*[F.struct(F.lit(f).alias("f"), b.alias("b")) for f, b in enumerate(binned)])
    grown = Trees(math.log(share / (1 - share)), [], [])
    rows = rows.withColumns({"bins": bins, "m": F.lit(grown.start)})
    for _ in range(trees):
        chance = 1 / (1 + F.exp(-F.col("m")))
        # Whole numbers add up alike in every order, so reruns agree.
        g, h = F.round((chance - F.col("y")) * _UNIT).cast("long"), F.round(chance * (1 - chance) * _UNIT).cast("long")
        rows = stored(rows.withColumns({"g": g, "h": h}), "boosted")
        tree: list[Split | None] = []
        for depth in range(DEPTH):
            sums = (
                rows.select(grown.node(tree, depth).alias("node"), "g", "h", F.explode("bins").alias("p"))
                .groupBy("node", "p.f", "p.b")
                .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .collect()
            )
            splits, sides = _splits(sums, depth, edges, names)
            tree += splits
        grown.splits.append(tree)
        grown.leaves.append([-RATE * g / (h + LEAST) for g, h in sides])
        rows = rows.withColumn("m", F.col("m") + grown.leaf(-1))
    return grown


Sums = tuple[float, float]


def _splits(sums: list, depth: int, edges: list[list[float]], names: list[str]) -> tuple[list[Split | None], list[Sums]]:
    """The best split of each node of a level, none where no split gains, and the sums of both its sides."""
    cells: dict[tuple[int, int], dict[int, Sums]] = {}
    for row in sums:
        cells.setdefault((row["node"], row["f"]), {})[row["b"]] = (row["g"] / _UNIT, row["h"] / _UNIT)
    first = (1 << depth) - 1
    chosen: list[Split | None] = []
    sides: list[Sums] = []
    for node in range(first, 2 * first + 1):
        whole = cells.get((node, 0), {}).values()
        g, h = sum(v[0] for v in whole), sum(v[1] for v in whole)
        best, split, left = 1e-6, None, (g, h)
        for f, own in enumerate(edges):
            bins = cells.get((node, f), {})
            gl = hl = 0.0
            for b, edge in enumerate(own):
                gl, hl = gl + bins.get(b, (0.0, 0.0))[0], hl + bins.get(b, (0.0, 0.0))[1]
                gain = gl**2 / (hl + LEAST) + (g - gl) ** 2 / (h - hl + LEAST) - g**2 / (h + LEAST)
                if gain > best:
                    best, split, left = gain, (names[f], edge), (gl, hl)
        chosen.append(split)
        sides += [left, (g - left[0], h - left[1])]
    return chosen, sides


def document_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, url, bad`` of pages whose url ends in the id of a labelled document: low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    known = labels.groupBy("doc_id").agg(F.max(bad).alias("bad")).filter("bad is not null")
    numbered = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id"))
    return numbered.join(known, "doc_id").select("url", "bad")


def trained_trees(ruled: DataFrame, suffixes: DataFrame, known: DataFrame | None = None, urls: int = TRAIN_URLS) -> Trees:
    """Trees fitted on at most about so many labelled URLs: those that a rule decides and those of ``known(url, bad)``.

    A URL counts once for each label it has, however many pages have it.
    """
    labelled = ruled.filter(F.col("ruled").isNotNull()).select("url", (F.col("ruled") == "block").cast("int").alias("y"))
    if known is not None:
        labelled = labelled.unionByName(known.select("url", F.col("bad").alias("y")))
    folders: list[str] = []
    with recorded(folders):
        labelled = stored(labelled.distinct(), "labels")
        share = max(1, -(-labelled.count() // urls))
        sample = labelled.filter(F.pmod(F.xxhash64("url"), F.lit(share)) == 0)
        named = sample.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        featured, names = with_features(named, suffixes)
        trees = grow(featured, names)
    for folder in folders:
        removed(ruled.sparkSession, folder)
    return trees


def judge(
    pages: DataFrame, labels: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row of ``pages(page_id, url)``.

    The trees decide the URLs that no rule fits, ``block`` at a score of
    ``threshold`` or more.  They learn from the URLs that a rule decides and,
    with ``labels(doc_id, quality, toxic)``, from those of labelled documents.

    A null url, or one without ``://``, has an empty host and path and is judged
    by the trees like any other.  Where nothing is labelled all are allowed with
    score 0.  Null and repeated ids are passed through row by row; null labels
    are left out and of repeated ones the bad counts; other columns are ignored;
    an empty table gives no rows.
    """
    ruled = with_rules(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), rules)
    suffixes = suffix_statistics(ruled)
    trees = trained_trees(ruled, suffixes, None if labels is None else document_labels(ruled, labels))
    featured, _ = with_features(ruled, suffixes)
    score = 1 / (1 + F.exp(-trees.margin())) if trees.splits else F.lit(0.0)
    learned = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return featured.withColumn("score", score).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score"
    )


@query()
def op8_boosted_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
