"""Parent-child hierarchies, walked level by level, and their closure, by doubling paths.

Every level or round is written to the shared folder before the next one starts, so the plan stays one join deep
and a lost executor costs at most one level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.spec import UNKNOWN_TEXT, ref
from histora.workspace import fresh_path, materialise


class HierarchyTooDeep(ValueError):
    """The hierarchy has more levels than the flattened table."""


class HierarchyCycle(ValueError):
    """A node is its own ancestor."""


def _clean(edges: DataFrame, child: str, parent: str) -> DataFrame:
    return (
        edges.select(ref(child).alias("child"), ref(parent).alias("parent"))
        .filter(F.col("child").isNotNull() & F.col("parent").isNotNull())
        .distinct()
    )


def _with_leaves(links: DataFrame, node: str, parent: str) -> DataFrame:
    """Mark the links whose node is nobody's parent: a walk need not go on from them."""
    forks = links.select(F.col(parent).alias("_fork")).distinct()
    return links.join(forks, F.col(node) == F.col("_fork"), "left").withColumn(
        "leaf_flag", F.when(F.col("_fork").isNull(), "1").otherwise("0")
    ).drop("_fork")


def _with_roots(links: DataFrame) -> DataFrame:
    """Mark the links whose parent is nobody's child."""
    inner = links.select(F.col("child").alias("_inner")).distinct()
    return links.join(inner, F.col("parent") == F.col("_inner"), "left").withColumn(
        "root_flag", F.when(F.col("_inner").isNull(), "1").otherwise("0")
    ).drop("_inner")


def hierarchy_closure(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """All pairs (ancestor, descendant) with their shortest distance, and whether the ancestor is a root
    and the descendant a leaf. A cycle is refused.

    Both flags belong to an edge and travel with the walk, so that only the edges are joined for them, not the far
    larger closure. Paths are doubled: a pair at a distance above 2^k and up to 2^(k+1) consists of one at exactly 2^k and one at
    2^k or less, so round k joins those two, and the rounds grow with the logarithm of the depth. In a tree every pair has
    one path; only where some node has several parents are the new pairs of a round compared with those reached before.
    """
    spark = edges.sparkSession
    clean = _clean(edges, child, parent)
    links = materialise(spark, "edges", _with_roots(_with_leaves(clean, "child", "parent")))
    is_tree = links.groupBy("child").count().filter(F.col("count") > 1).isEmpty()
    found = links.select(
        F.col("parent").alias("ancestor"),
        F.col("child").alias("descendant"),
        F.lit(1).alias("depth"),
        "root_flag",
        "leaf_flag",
    )
    base, paths, reach = fresh_path(spark, "closure"), [], 1
    while True:
        # what is not further than `reach`, the power of two
        paths.append(f"{base}/reach={reach}")
        found.write.parquet(paths[-1])
        stored = spark.read.schema(found.schema).parquet(paths[-1])
        own, furthest = F.col("ancestor") == F.col("descendant"), F.col("depth") == reach
        inner, cycle = stored.agg(F.max((F.col("leaf_flag") == "0") & furthest), F.max(F.when(own, F.col("ancestor")))).first()
        if cycle is not None:
            raise HierarchyCycle(f"{cycle} is its own ancestor")
        reached = spark.read.schema(found.schema).parquet(*paths)
        if not inner:
            return reached
        above = stored.filter((F.col("leaf_flag") == "0") & furthest)
        above = above.select("ancestor", F.col("descendant").alias("middle"), F.col("depth").alias("first"), "root_flag")
        below = reached.select(F.col("ancestor").alias("middle"), "descendant", "depth", "leaf_flag")
        found = above.join(below, "middle").select(
            "ancestor", "descendant", (F.col("first") + F.col("depth")).alias("depth"), "root_flag", "leaf_flag"
        )
        if not is_tree:
            found = found.groupBy("ancestor", "descendant", "root_flag", "leaf_flag").agg(F.min("depth").alias("depth"))
            found = found.join(reached.select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti")
            found = found.select("ancestor", "descendant", "depth", "root_flag", "leaf_flag")
        reach *= 2


def _walk(first: DataFrame, step, max_depth: int, name: str) -> DataFrame:
    """Union of all levels: the first one, then step(rows of the level before that are no leaves)."""
    spark = first.sparkSession
    base = fresh_path(spark, name)
    level, paths = first, []
    while True:
        paths.append(f"{base}/depth={len(paths)}")
        level.write.parquet(paths[-1])
        inner = spark.read.schema(level.schema).parquet(paths[-1]).filter(F.col("leaf_flag") == "0")
        if inner.isEmpty():
            return spark.read.schema(first.schema).parquet(*paths)
        if len(paths) >= max_depth:
            raise HierarchyTooDeep(f"rows left after {max_depth} levels: a cycle, or levels is too small")
        level = step(inner)


def hierarchy_flatten(
    edges: DataFrame,
    child: str,
    parent: str,
    name: str,
    roots: DataFrame,
    levels: int = 31,
    sep: str = "|",
) -> DataFrame:
    """One row per node and path from a root: level, names joined to a tree vector, code and name per level.

    edges: (child, parent, name of the child); roots: (child, name) of the nodes without a parent.
    A node with several parents gets one row per path. A missing name shows as '#NA#' in the tree vector. Nodes that no
    root reaches (orphans, cycles off the roots) come back once each, with nothing but their code.
    """
    links = edges.select(
        ref(child).alias("node"), ref(parent).alias("parent"), ref(name).alias("name")
    ).filter(F.col("parent").isNotNull())
    links = materialise(edges.sparkSession, "edges", _with_leaves(links.distinct(), "node", "parent"))

    def entry(code: Column, label: Column) -> Column:
        return F.struct(code.alias("code"), label.alias("name"))

    top = roots.select(
        ref(child).alias("node"),
        F.lit(0).alias("level"),
        F.array(entry(ref(child), ref(name))).alias("path"),
        F.lit("0").alias("leaf_flag"),
    )

    def down(level: DataFrame) -> DataFrame:
        above = level.select(F.col("node").alias("parent"), "level", "path")
        return above.join(links, "parent").select(
            "node",
            (F.col("level") + 1).alias("level"),
            F.array_append("path", entry(F.col("node"), F.col("name"))).alias("path"),
            "leaf_flag",
        )

    walked = _walk(top, down, levels, "flatten")
    nodes = _clean(edges, child, parent).select(F.explode(F.array("child", "parent")).alias("node")).distinct()
    lost = nodes.join(walked.select("node").distinct(), "node", "left_anti")
    nothing = [F.lit(None).cast(walked.schema[c].dataType).alias(c) for c in walked.columns if c != "node"]
    walked = walked.unionByName(lost.select("node", *nothing))
    out = [
        F.col("node"),
        F.col("level").alias("LevelNumber"),
        F.array_join(F.transform("path", lambda p: p["name"]), sep, UNKNOWN_TEXT).alias("TreeVector"),
    ]
    for i in range(levels):
        step = F.get("path", F.lit(i))
        out.append(step["code"].alias(f"CodeLevel{i:02d}"))
        out.append(step["name"].alias(f"Level{i:02d}"))
    return walked.select(*out)
