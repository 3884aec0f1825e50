"""URL filter by a tree of path templates, of DataFrame expressions only.

Each host's paths are cut into segments. A segment is variable if it is a number, a long hexadecimal string, or holds a digit, and
becomes a typed wildcard; literal segments become `{*}` below a node that has many of them and few pages for each, level by level. Then
branches below a node that are statistically alike are merged, again level by level: those with the same templates below them, whose
share of blocked labels is no further from the others' than two standard deviations (a test of two proportions; branches without labels
are known by those of the same templates on other hosts, and those without any are like each other alone). Merged branches are judged together. A template's labels are the verdicts of the rules on its pages; its purity is the
share of blocked labels, smoothed towards that of the same template over all hosts. A page that no rule fits is blocked if its merged
template's purity is above a threshold; one equal to it is allowed.

Wildcards are looked for as deep as some host has more path forms than a node needs to become one, branches at every level at which
some node has several.

Null urls and those without `://` have empty host and path; the rules don't fit them. Without any labelled page all are allowed.
Paths are first counted per host and typed path, so the tree works on templates and not on pages; a hot host or path is one
pre-aggregated row. Repeated rows get equal results, an empty table gives an empty one, and urls are taken whole, however long. Columns
beside page_id and url go along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, shielded, staged

#: (verdict, host and path prefix)
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
#: A node's literal children become a wildcard beyond so many, if there are fewer pages than so many for each.
MOST_CHILDREN, PAGES_EACH = 30, 3
#: Weight of the prior in a purity, the threshold, and the square of the standard deviations within which shares are alike.
PRIOR_WEIGHT, THRESHOLD, ALIKE = 4.0, 0.5, 4.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the longest comes to stand first
        name, prefix = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def typed(segment: Column) -> Column:
    s = F.lower(segment)
    stem, ending = F.regexp_replace(s, r"\.[a-z]{1,5}$", ""), F.regexp_extract(s, r"(\.[a-z]{1,5})$", 1)
    kind = F.when(stem.rlike(r"^[0-9]+$"), F.lit("{n}")).when(stem.rlike(r"^[0-9a-f\-]{8,}$") & stem.rlike("[0-9]"), F.lit("{h}")).when(stem.rlike("[0-9]"), F.lit("{a}")).otherwise(stem)
    return F.concat(kind, ending)


@shielded(("page_id", "url"))
def judged(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """pages with host, path, rule, template, purity and verdict."""
    host, path = host_and_path(F.col(url))
    rows = pages.withColumns({"host": host, "path": path}).withColumn("_fit", rule_of(F.col("host"), F.col("path"), rules))
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    rows = rows.withColumn("_p", F.transform(segments, typed))
    # templates as they are typed: one row for each host and path form, staged because the tree goes over them several times
    paths = rows.groupBy("host", "_p").agg(F.count("*").alias("n"), F.count_if(F.col("_fit.verdict") == "block").alias("bad"), F.count_if(F.col("_fit").isNotNull()).alias("labelled")).withColumn("t", F.col("_p"))
    paths = staged(paths, "paths")
    for level in range(1, _depth(paths) + 1):
        paths, last = staged(_generalised(paths, level), "paths"), paths
        discard(last)
    shape = ["host", "t", *[F.col(c).cast("long").alias(c) for c in ("bad", "labelled")], F.col("t").alias("g")]
    tree = staged(paths.groupBy("host", "t").agg(*[F.sum(c).alias(c) for c in ("bad", "labelled")]).select(*shape), "tree")
    everywhere = tree.groupBy("t").agg(F.sum("bad").alias("all_bad"), F.sum("labelled").alias("all_labelled"))
    tree, last = staged(tree.join(everywhere, "t"), "tree"), tree
    discard(last)
    for level in _forks(tree):
        tree, last = staged(_merged(tree, level), "tree"), tree
        discard(last)
    tree, last = staged(_pure(tree), "tree"), tree
    discard(last)
    known = paths.select("host", "_p", "t").join(tree, ["host", "t"])
    got = rows.join(known.select(F.col("host").alias("_h"), F.col("_p").alias("_q"), F.concat(F.lit("/"), F.array_join("t", "/")).alias("template"), "purity"), (F.col("host") == F.col("_h")) & (F.col("_p") == F.col("_q")), "left")
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(F.col("purity") > THRESHOLD, F.lit("block")).otherwise(F.lit("allow")))
    return got.withColumns({"rule": F.col("_fit.rule"), "verdict": verdict}).drop("_fit", "_p", "_h", "_q")


def _depth(paths: DataFrame) -> int:
    """The deepest level at which some host has more path forms than MOST_CHILDREN."""
    sizes = paths.groupBy("host", F.size("t").alias("size")).agg(F.count("*").alias("c"))
    deeper = F.sum("c").over(Window.partitionBy("host").orderBy(F.desc("size")))
    return sizes.withColumn("c", deeper).filter(F.col("c") > MOST_CHILDREN).agg(F.max("size")).first()[0] or 0


def _forks(tree: DataFrame) -> list[int]:
    """The levels at which some node has several branches."""
    at = tree.filter(F.size("t") > 0).select("host", "t", F.explode(F.sequence(F.lit(1), F.size("t"))).alias("level"))
    nodes = at.groupBy("host", "level", F.xxhash64(F.slice("t", F.lit(1), F.col("level") - 1)).alias("above")).agg(F.min(F.get("t", F.col("level") - 1)).alias("a"), F.max(F.get("t", F.col("level") - 1)).alias("z"))
    return sorted(r[0] for r in nodes.filter("a <> z").select("level").distinct().collect())


def _generalised(paths: DataFrame, depth: int) -> DataFrame:
    """paths with the literal segments of one level as wildcards where their node has many of them and few pages for each."""
    literal = F.when(F.size("t") >= depth, ~F.get("t", F.lit(depth - 1)).contains("{")).otherwise(F.lit(False))
    above = F.slice("t", 1, depth - 1) if depth > 1 else F.array().cast("array<string>")
    paths = paths.withColumn("_above", above)
    children = paths.filter(literal).groupBy("host", "_above", F.get("t", F.lit(depth - 1)).alias("c")).agg(F.sum("n").alias("n"))
    wide = children.groupBy("host", "_above").agg(F.count("*").alias("c"), F.sum("n").alias("n")).filter((F.col("c") > MOST_CHILDREN) & (F.col("n") < PAGES_EACH * F.col("c"))).select("host", "_above", F.lit(True).alias("_wide"))
    starred = F.concat(F.slice("t", 1, depth - 1) if depth > 1 else F.array().cast("array<string>"), F.array(F.lit("{*}")), F.slice("t", F.lit(depth + 1), F.size("t")))
    return paths.join(wide, ["host", "_above"], "left").withColumn("t", F.when(F.coalesce("_wide", F.lit(False)) & literal, starred).otherwise(F.col("t"))).drop("_above", "_wide")


def _merged(tree: DataFrame, level: int) -> DataFrame:
    """tree with the segments of one level of g, the merged template, as one mark where their branches are alike."""
    child = F.get("t", F.lit(level - 1))
    rest = F.array_join(F.slice("t", F.lit(level + 1), F.size("t")), "/")
    above = F.slice("g", 1, level - 1) if level > 1 else F.array().cast("array<string>")
    rows = tree.withColumns({"_above": above, "_child": child, "_rest": rest})
    at = rows.filter(child.isNotNull())
    # what stands below a branch, as a digest of the set: its size and a sum of hashes
    counts = ("bad", "labelled", "all_bad", "all_labelled")
    below = at.groupBy("host", "_above", "_child", "_rest").agg(*[F.sum(c).alias(c) for c in counts])
    digest = lambda seed: F.sum(F.xxhash64("_rest", F.lit(seed)).cast("decimal(38,0)"))
    branch = below.groupBy("host", "_above", "_child").agg(*[F.sum(c).alias(c) for c in counts], F.count("*").alias("k"), digest(1).alias("x"), digest(2).alias("y"))
    # a branch without labels is known by those of its like on other hosts; those without any are apart
    own = F.col("labelled") > 0
    branch = branch.withColumns({"b": F.when(own, F.col("bad")).otherwise(F.col("all_bad")), "n": F.when(own, F.col("labelled")).otherwise(F.col("all_labelled"))}).withColumn("known", F.col("n") > 0)
    kind = Window.partitionBy("host", "_above", "k", "x", "y", "known")  # a pre-aggregated row for each branch of a node
    b, n, total_b, total_n = (c.cast("double") for c in (F.col("b"), F.col("n"), F.sum("b").over(kind), F.sum("n").over(kind)))
    alike = (b * total_n - total_b * n) * (b * total_n - total_b * n) * total_n <= ALIKE * total_b * (total_n - total_b) * n * (total_n - n)
    mark = F.concat(F.when(F.col("known"), F.lit("~")).otherwise(F.lit("?")), F.hex(F.xxhash64("k", "x", "y")))
    branch = branch.withColumn("_new", F.when(alike, mark).otherwise(F.col("_child"))).select("host", "_above", "_child", "_new")
    g = F.when(F.col("_new").isNull(), F.col("g")).otherwise(F.concat(F.col("_above"), F.array("_new"), F.slice("g", F.lit(level + 1), F.size("g"))))
    return rows.join(branch, ["host", "_above", "_child"], "left").select("t", "host", *counts, g.alias("g"))


def _pure(tree: DataFrame) -> DataFrame:
    """(host, t, purity): templates that are merged share their counts."""
    rows = tree.withColumns({"prior": (F.col("all_bad") + 1) / (F.col("all_labelled") + 2), "seen": F.col("all_labelled") > 0})
    pooled = rows.groupBy("host", "g").agg(F.sum("bad").alias("pb"), F.sum("labelled").alias("pl"), F.avg("prior").alias("prior"), F.max("seen").alias("seen"))
    smooth = (F.col("pb") + PRIOR_WEIGHT * F.col("prior")) / (F.col("pl") + PRIOR_WEIGHT)
    pooled = pooled.select("host", "g", F.when(F.col("seen") | (F.col("pl") > 0), F.round(smooth, 9)).otherwise(F.lit(0.0)).alias("purity"))
    return rows.select("host", "t", "g").join(pooled, ["host", "g"]).select("host", "t", "purity")
