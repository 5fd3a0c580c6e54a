"""Graph operators: reachability and components by distributed rounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def written(df: DataFrame, name: str = "graph") -> DataFrame:
    """Cut the lineage by a table in the cluster's shared folder, spark.checkpoint.dir.

    A local session may do without it; a cluster may not.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file:///tmp/strataleaf-" + spark.sparkContext.applicationId
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(edges: DataFrame, src: str, dst: str, roots: DataFrame) -> DataFrame:
    """(root, node) of all nodes reachable from roots (column `root`), the root included; cycles are safe."""
    edges = edges.select(F.col(src).alias("__from"), F.col(dst).alias("__to")).where("__from IS NOT NULL AND __to IS NOT NULL").distinct()
    front = seen = written(roots.select("root", F.col("root").alias("node")).distinct())
    while True:
        new = front.join(edges, F.col("node") == F.col("__from")).select("root", F.col("__to").alias("node")).distinct()
        front = written(new.join(seen, ["root", "node"], "left_anti"))
        if front.isEmpty():
            return seen
        seen = written(seen.unionByName(front))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node of each connected component, for nodes with an edge.

    Labels fall to the least label among neighbours and then jump to that label's own label, until no
    label changes; the sum of labels shows that.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = written(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("component")))
    last = None
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("component").alias("c"))
        low = labels.join(near, labels.node == near.u, "left").select("node", F.least("component", F.coalesce("c", "component")).alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("j"))
        labels = written(low.join(jump, "component", "left").select("node", F.least(F.col("component"), F.coalesce("j", "component")).alias("component")))
        now = labels.agg(F.sum(F.xxhash64("node", "component").cast("decimal(38,0)"))).first()[0]
        if now == last:
            return labels
        last = now


def reached_counts(edges: DataFrame, a: str, b: str, roots: DataFrame) -> DataFrame:
    """(root, reached): how many nodes reachable() would pair with each root, itself included, where every edge goes both ways.

    What a root reaches then is its component, so that members are counted once for each component and the pairs, as
    many as the squares of components, are never made. A null root reaches no node.
    """
    members = components(edges, a, b)
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("__n"))
    found = roots.select("root").distinct().join(members, F.col("root") == F.col("node"), "left").join(sizes, "component", "left")
    return found.select("root", F.when(F.col("root").isNull(), 0).otherwise(F.coalesce("__n", F.lit(1))).cast("long").alias("reached"))
