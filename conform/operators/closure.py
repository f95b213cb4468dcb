"""Closure of a hierarchy whose depth is data: root and depth of every node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.operators.joins import needs_salt, salted_join
from conform.session import stored


def hierarchy(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """``key, root, depth`` of every node: the ancestor without a parent and the number of steps to it.

    Semi-naive with doubling: each round only the nodes that have not reached a root take part, and each follows the pointer
    of the node it points at, so a chain of n levels takes log2(n) rounds. A round's result is stored; what has arrived is written once and
    never joined as a left side again. A parent that is no node counts as none, so its children are roots. Nodes on a cycle, and
    those below one, have a NULL root and depth: they are left when the distance exceeds the number of nodes. Rows with a NULL key are left
    out; a repeated key fails the job.
    """
    doubled = F.raise_error(F.concat(F.lit("repeated key: "), F.col("node").cast("string")))
    counted = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("node")).agg(F.count(F.lit(1)).alias("n"), F.first(parent).alias("up"))
    nodes = stored(counted.select("node", F.when(F.col("n") == 1, F.col("up")).otherwise(doubled).alias("up")), "closure-nodes")
    known = nodes.select(F.col("node").alias("up"), F.lit(True).alias("there"))

    def follow(left: DataFrame, right: DataFrame) -> DataFrame:
        """A parent with very many children is spread."""
        if needs_salt(left, right):
            return salted_join(left, right, ["up"], salt_by=["node"])
        return left.join(right, "up", "left")

    linked = follow(nodes, known).select("node", F.when(F.col("there"), F.col("up")).alias("up"))
    state = stored(linked.withColumn("dist", F.col("up").isNotNull().cast("long")), "closure-state")
    done = [state.where("up is null").select("node", F.col("node").alias("root"), F.col("dist").alias("depth"))]
    left = state.where("up is not null")
    limit, reach = nodes.count(), 1
    while reach <= 2 * limit and not left.isEmpty():
        # Of the node pointed at: its root if it has arrived, or else its pointer. Only this round's arrivals are new.
        arrived = done[0]
        for part in done[1:]:
            arrived = arrived.unionByName(part)
        steps = arrived.select(F.col("node").alias("up"), F.col("root").alias("to"), F.col("depth").alias("more"), F.lit(True).alias("end"))
        steps = steps.unionByName(left.select(F.col("node").alias("up"), F.col("up").alias("to"), F.col("dist").alias("more"), F.lit(False).alias("end")))
        moved = follow(left, steps).select("node", F.col("to").alias("up"), (F.col("dist") + F.col("more")).alias("dist"), "end")
        moved = stored(moved, "closure-round")
        done.append(moved.where("end").select("node", F.col("up").alias("root"), F.col("dist").alias("depth")))
        left = moved.where("not end").select("node", "up", "dist")
        reach *= 2
    out = left.select("node", F.lit(None).cast(nodes.schema["node"].dataType).alias("root"), F.lit(None).cast("long").alias("depth"))
    for part in done:
        out = out.unionByName(part)
    return out.select(F.col("node").alias(key), "root", "depth")
