"""Closures over role grants and trees over spans.

Closures and trees double the depth they have reached, so their steps grow with the logarithm
of the depth. Every step is written to the shared folder once. There is no depth cap: the
steps end when nothing is new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.operators.joins import left_join_sparse
from sparkgauge.session import cut_lineage


def role_closure(edges: DataFrame, roles: DataFrame | None = None, parent: str = "parent", child: str = "child") -> DataFrame:
    """Every role reachable from a role with its least depth, plus each role itself at depth 0.

    A step doubles the depth reached: a pair whose least depth lies above d and up to 2 d has on
    its way a role at depth d exactly, from which the rest is known. So only the pairs at depth d
    meet the known ones, a step makes little more rows than are new, and the number of steps
    grows with the logarithm of the depth; cycles end by themselves.
    """
    first = edges.select(F.col(parent).alias("parent"), F.col(child).alias("child")).distinct()
    closure = border = cut_lineage(first.withColumn("depth", F.lit(1).cast("bigint")))
    depth = 1
    while not border.isEmpty():
        rest = closure.select(F.col("parent").alias("child"), F.col("child").alias("_next"), F.col("depth").alias("_more"))
        reached = border.join(rest, "child").groupBy("parent", F.col("_next").alias("child")).agg((F.min("_more") + depth).alias("depth"))
        new = cut_lineage(reached.join(closure.select("parent", "child"), ["parent", "child"], "left_anti"))
        closure = closure.unionByName(new)
        depth *= 2
        border = new.filter(F.col("depth") == depth)
    if roles is None:
        return closure
    own = roles.select(F.col("name").alias("parent"), F.col("name").alias("child")).distinct()
    return closure.unionByName(own.withColumn("depth", F.lit(0).cast("bigint")))


def privilege_closure(grants: DataFrame, roles: DataFrame) -> DataFrame:
    """Privileges reachable from a role: only role grants are followed, others end the path.

    Columns parent, privilege, granted_on, child, depth; each role also has USAGE on itself at depth 0.
    A granted object is looked up once from every role that reaches its holder.
    """
    role_grants = grants.filter(F.col("granted_on") == "ROLE")
    reach = role_closure(role_grants)
    holders = reach.select("parent", F.col("child").alias("_holder"), "depth")
    own = grants.select(F.col("parent").alias("_holder"), "privilege", "granted_on", "child").distinct()
    through = holders.join(own, "_holder").select(
        "parent", "privilege", "granted_on", "child", (F.col("depth") + 1).alias("depth")
    )
    direct = own.select(F.col("_holder").alias("parent"), "privilege", "granted_on", "child").withColumn(
        "depth", F.lit(1).cast("bigint")
    )
    closure = direct.unionByName(through).groupBy("parent", "privilege", "granted_on", "child").agg(
        F.min("depth").alias("depth")
    )
    self_usage = roles.select(
        F.col("name").alias("parent"),
        F.lit("USAGE").alias("privilege"),
        F.lit("ROLE").alias("granted_on"),
        F.col("name").alias("child"),
        F.lit(0).cast("bigint").alias("depth"),
    ).distinct()
    return closure.unionByName(self_usage)


def span_tree(rows: DataFrame, span_id: str, parent_id: str, trace_id: str) -> DataFrame:
    """Attach every row below a root: root id, level, inherited trace, span kind, cyclic.

    A root has no parent among the rows. Its trace passes down; the root's kind is
    SERVER, all others are INTERNAL. Every open row points to an ancestor and takes over the
    pointer of that ancestor, which doubles the distance per step. Rows on or below a parent
    cycle reach no root: they are their own roots, at level 0, flagged as cyclic. Span ids are
    unique; of a repeated one the row with the smallest parent counts.
    """
    known = rows.select(F.col(span_id).alias(parent_id)).distinct().withColumn("_known", F.lit(True))
    spans = left_join_sparse(rows, known, parent_id, span_id).select(
        F.col(span_id).alias("span_id"),
        F.col(parent_id).alias("parent_id"),
        F.col(trace_id).alias("own_trace"),
        F.col("_known").isNull().alias("_root"),
    )
    first = F.min(F.struct("parent_id", "own_trace", "_root")).alias("_row")
    linked = cut_lineage(spans.groupBy("span_id").agg(first).select("span_id", "_row.*"))
    done = [
        linked.filter("_root").select(
            "span_id", "parent_id", F.col("span_id").alias("root_id"), F.col("own_trace").alias("trace_id"), F.lit(0).cast("bigint").alias("level")
        )
    ]
    still_open = linked.filter("NOT _root").select("span_id", "parent_id", F.col("parent_id").alias("_up"), F.lit(1).cast("bigint").alias("level"))
    while True:
        ends = reduce(DataFrame.unionByName, done).select(
            F.col("span_id").alias("_up"), F.col("root_id").alias("_next"), F.col("level").alias("_more"), "trace_id", F.lit(True).alias("_done")
        )
        jumps = still_open.select(
            F.col("span_id").alias("_up"), F.col("_up").alias("_next"), F.col("level").alias("_more"), F.lit(None).cast(linked.schema["own_trace"].dataType).alias("trace_id"), F.lit(False).alias("_done")
        )
        moved = cut_lineage(
            still_open.join(ends.unionByName(jumps), "_up").select(
                "span_id", "parent_id", F.col("_next").alias("_up"), (F.col("level") + F.col("_more")).alias("level"), "trace_id", "_done"
            )
        )
        # Levels below a root have no gaps, so a step that ends no row leaves only cycles.
        reached = moved.filter("_done")
        if reached.isEmpty():
            break
        done.append(reached.select("span_id", "parent_id", F.col("_up").alias("root_id"), "trace_id", "level"))
        still_open = moved.filter("NOT _done").select("span_id", "parent_id", "_up", "level")
    tree = reduce(DataFrame.unionByName, done).withColumn("cyclic", F.lit(False))
    own = linked.select("span_id", "parent_id", F.col("span_id").alias("root_id"), F.col("own_trace").alias("trace_id"), F.lit(0).cast("bigint").alias("level"))
    cycles = own.join(still_open.select("span_id"), "span_id", "left_semi").withColumn("cyclic", F.lit(True))
    return tree.unionByName(cycles).withColumn("kind", F.when(F.col("level") == 0, F.lit("SERVER")).otherwise(F.lit("INTERNAL")))
