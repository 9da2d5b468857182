"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import checkpointed

# Links up to which their places may be sent to every task. Files of numbers do not show how many they hold.
SEND = 100_000


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of a link; the component is its smallest node.

    Nodes are integers. Links may repeat, run in both directions or join a node with itself; a
    node that has only itself is its own component. Links with a null end are left out.

    In every round each node moves to that one of itself and its neighbours that has the smallest
    hash, and links inside one place go. A round leaves a part of the links at most, on average,
    so the rounds are logarithmic, and chains take no more of them than stars. A hub's links are
    split by adaptive skew joins; its best neighbour comes from a partial aggregate. Places of more
    than ``SEND`` links are joined by shuffles and never pass through the driver.
    """

    def placed(places: DataFrame, links: int) -> DataFrame:
        return places.hint("merge") if links > SEND else places

    a, b = F.col(f"`{left}`").cast("bigint"), F.col(f"`{right}`").cast("bigint")
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(a.isNotNull() & b.isNotNull())
    alone = ends.filter("u = v").select(F.col("u").alias("node"))
    edges = checkpointed(ends.filter("u <> v").distinct())
    place = None
    turn = 0
    total = count = edges.count()
    while count:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))

        def rank(node: str):
            return F.struct(F.xxhash64(F.lit(turn), node).alias("rank"), F.col(node).alias("to"))

        moved = both.groupBy("u").agg(F.min(rank("v")).alias("best")).select("u", F.least("best", rank("u"))["to"].alias("to"))
        moved = checkpointed(moved)
        first = edges.join(placed(moved, count), "u").select("v", F.col("to").alias("_u"))
        second = first.join(placed(moved, count), first["v"] == moved["u"]).select("_u", F.col("to").alias("_v")).filter("_u <> _v")
        edges = checkpointed(second.select(F.greatest("_u", "_v").alias("u"), F.least("_u", "_v").alias("v")).distinct())
        if place is None:
            place = moved.select(F.col("u").alias("node"), "to")
        else:
            further = moved.select(F.col("u").alias("to"), F.col("to").alias("_to"))
            place = checkpointed(place.join(placed(further, count), "to", "left").select("node", F.coalesce("_to", "to").alias("to")))
        turn += 1
        count = edges.count()
    own = alone.distinct().select("node", F.col("node").alias("component"))
    if place is None:
        return own
    smallest = place.groupBy("to").agg(F.min("node").alias("component"))
    found = place.join(placed(smallest, total), "to").select("node", "component")
    return found.union(own).groupBy("node").agg(F.min("component").alias("component"))
