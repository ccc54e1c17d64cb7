"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimkeeper.sources.scratch import materialise

#: Names from here downwards stand for contents that share their id with another one.
FURTHER = -(1 << 62)


def node_name(own_id: str, content: list[str]) -> Column:
    """A name for each content of an id: the id itself for the least content, for others a hash below ``FURTHER``.

    So names tell contents apart where an id is repeated, and are the ids where it is not (ids are above ``FURTHER``).
    """
    first = F.struct(*content) == F.min(F.struct(*content)).over(Window.partitionBy(own_id))
    other = F.lit(FURTHER) - F.pmod(F.xxhash64(own_id, *content), F.lit(1 << 61))
    return F.when(first, F.col(own_id)).otherwise(other)


def least_ids(found: DataFrame, own_id: str) -> DataFrame:
    """``found`` (node named by ``node_name``, component, own_id) with the component's smallest id as component.

    A component's label is its smallest name; that is its smallest id unless one of its names is a further one.
    """
    plain = found.where(F.col("component").isNull() | (F.col("component") > FURTHER))
    others = found.where(F.col("component") <= FURTHER)
    least = others.groupBy("component").agg(F.min(own_id).alias("least"))
    mended = others.join(least, "component").withColumn("component", F.col("least")).select(*found.columns)
    return plain.select(*found.columns).unionByName(mended)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of a link, with the smallest node that links reach.

    Every round gives a node the least label of itself and its neighbours, then the label that its
    label had (pointer jumping), so a chain of n links takes about log n rounds. Each round is
    stored in the shared folder; the number of changed labels is all the driver sees.
    """
    two_way = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    two_way = materialise(two_way.unionByName(two_way.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = materialise(two_way.groupBy("node").agg(F.least("node", F.min("other")).alias("component")))
    while True:
        near = two_way.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        least = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("label"))
        target = labels.select(F.col("node").alias("label"), F.col("component").alias("further"))
        after = materialise(
            least.join(target, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("component"), F.col("was"))
        )
        labels = after.select("node", "component")
        if after.where("was <> component").isEmpty():
            return labels
