"""Merkle manifest of a dataset: group trees of eight children, a root over the groups, and a proof for every row.

Nodes are labelled with the interval of leaf ranks that they cover.  A node of
level l begins at a multiple of 8^l, so a child and its parent share the bucket
``begin // 8^(l + 1)`` of the parent's level, and a join on that bucket with
the containment of the intervals attaches the parent.  What is left of the
parent's interval before and after the child's are the child's siblings.

Going up, a level is one aggregation of at most eight digests a node.  Going
down, a node takes its parent's path and adds its own siblings, so long paths
are shuffled for the parents of leaves only, an eighth of the rows.  Ranks come
from the distributed index; no group of rows, however large, meets in one task,
and only a row count, the size of the largest group and the number of groups
reach the driver.  Every level is a written table, so a lost executor costs a
level at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import global_index, group_index
from .common import materialise

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of the fields: ``-`` for a null, else the count of UTF-8 bytes, ``:`` and the value."""
    def part(c):
        s = c.cast("string")
        return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return digest(F.concat(*map(part, fields)))


def levels(leaves: DataFrame, most: int) -> list[DataFrame]:
    """All levels from ``leaves`` up, each with (grp, size, begin, end, digest, children).

    ``leaves`` has (grp, size, begin, digest) and may have more columns:
    ``begin`` is the rank in the group and ``size`` the group's leaves.  A group
    goes on to the next level while it has several nodes, so its last table
    holds it as one node, the subroot.  ``most`` is the size of the largest
    group.
    """
    child = F.struct("begin", "end", "digest")
    out = [leaves.withColumn("end", F.col("begin") + 1)
           .withColumn("children", F.lit(None).cast("array<struct<begin:bigint,end:bigint,digest:string>>"))]
    span = 1
    while span < most:
        several = out[-1].filter(F.col("size") > span)
        span *= ARITY
        up = several.groupBy("grp", F.floor(F.col("begin") / span).alias("bucket")) \
            .agg(F.max("size").alias("size"), F.sort_array(F.collect_list(child)).alias("children"))
        out.append(materialise(up.select(
            "grp", "size", F.array_min("children.begin").alias("begin"), F.array_max("children.end").alias("end"),
            digest(F.array_join("children.digest", "")).alias("digest"), "children")))
    return out


def subroots(tree: list[DataFrame]) -> DataFrame:
    """(grp, digest): the single node of each group."""
    tops = [t.filter(F.col("size") <= ARITY ** k).select("grp", "digest") for k, t in enumerate(tree)]
    return reduce(DataFrame.unionByName, tops)


def attach(nodes: DataFrame, parents: DataFrame, span: int) -> DataFrame:
    """``nodes`` with ``path``: the siblings of each node, then its parent's path.

    ``span`` is the parents' full width, the size of a bucket of their level.
    """
    p = parents.select(F.col("grp").alias("p_grp"), F.floor(F.col("begin") / span).alias("p_bucket"),
                       F.col("begin").alias("p_begin"), F.col("end").alias("p_end"),
                       F.col("children").alias("p_children"), F.col("path").alias("p_path"))
    inside = F.col("grp").eqNullSafe(F.col("p_grp")) & (F.floor(F.col("begin") / span) == F.col("p_bucket")) \
        & (F.col("begin") >= F.col("p_begin")) & (F.col("end") <= F.col("p_end"))
    before = F.filter("p_children", lambda c: c["end"] <= F.col("begin"))
    after = F.filter("p_children", lambda c: c["begin"] >= F.col("end"))
    own = F.struct(F.array_join(before["digest"], "").alias("left"), F.array_join(after["digest"], "").alias("right"))
    return nodes.join(p, inside).select(*nodes.columns, F.concat(F.array(own), "p_path").alias("path"))


def paths(tree: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The leaves of ``tree`` with ``path``: (left, right) siblings at each level, from the leaf's to the root's.

    ``roots`` has (r_grp, r_path): the levels that follow a group's subroot.
    """
    met = F.col("grp").eqNullSafe(F.col("r_grp"))
    out = None
    for k in reversed(range(len(tree))):
        single = F.col("size") <= ARITY ** k
        top = tree[k].filter(single).join(roots, met).select(*tree[k].columns, F.col("r_path").alias("path"))
        if out is not None:
            top = top.unionByName(attach(tree[k].filter(~single), out, ARITY ** (k + 1)))
        out = materialise(top) if k else top
    return out


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group_col: str = "lang", id_col: str = "doc_id",
             **carried: Column) -> DataFrame:
    """(id, grp, leaf, subroot, root, path), one row for each row of ``docs``, and the columns ``carried``.

    A leaf is the digest of a row's ``fields``.  In each group leaves ascend by
    id, null ids first; rows that share an id are ordered by their leaves, and
    rows repeated in full are leaves of their own, which cannot be told apart.
    Every eight consecutive nodes of a level, the last run maybe fewer, become
    the digest of their digests until one is left, the subroot.  Subroots in
    order of their groups, null first and else by bytes, make the root in the
    same way.  ``path`` holds the digests of the siblings to the left and to the
    right at each level from the leaf to the root.

    Null and empty values are told apart, texts are hashed whole, other columns
    of ``docs`` are not read, whatever their names, and an empty table gives no
    rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
                       leaf_digest([F.col(f) for f in fields]).alias("digest"), *[c.alias(n) for n, c in carried.items()])
    # the row's place breaks ties, so that a much-repeated row is spread over range partitions
    rows = group_index(rows.withColumn("_at", F.monotonically_increasing_id()), ["grp"], ["id", "digest", "_at"],
                       name="begin", base=0).drop("_at")
    rows = materialise(rows)
    sizes = materialise(rows.groupBy(F.col("grp").alias("s_grp")).agg(F.count(F.lit(1)).alias("size")))
    n_groups, most = sizes.agg(F.count(F.lit(1)), F.max("size")).first()
    leaves = rows.join(sizes, F.col("grp").eqNullSafe(F.col("s_grp"))).drop("s_grp")
    tree = levels(leaves, most or 1)
    # the second tree: one group whose leaves are the subroots
    ranked = materialise(global_index(subroots(tree), [F.col("grp").asc_nulls_first()], name="begin"))
    top = levels(ranked.select(F.lit(0).alias("grp"), F.lit(n_groups).cast("long").alias("size"), "begin", "digest",
                               F.col("grp").alias("lang")), n_groups)
    start = docs.sparkSession.range(1).select(F.lit(0).alias("r_grp"), F.array().cast(PATH).alias("r_path"))
    root = subroots(top).select(F.col("digest").alias("root"))
    heads = materialise(paths(top, start).crossJoin(root).select("lang", F.col("digest").alias("subroot"), "root", "path"))
    found = paths(tree, heads.select(F.col("lang").alias("r_grp"), F.col("path").alias("r_path")))
    heads = heads.select(F.col("lang").alias("h_grp"), "subroot", "root")
    return found.join(heads, F.col("grp").eqNullSafe(F.col("h_grp"))) \
        .select("id", "grp", F.col("digest").alias("leaf"), "subroot", "root", "path", *carried)


def proof_digest(path: Column) -> Column:
    """H of all sibling digests of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))
