"""Sharding with a hierarchical weighted hash tree.

Main path: DataFrame functions only.  A row descends region, rack and shard;
at each node every child draws a number from the hash of (row key, child name),
turned into an exponential waiting time divided by the child's weight, and the
smallest wins.  A child's draw depends on nothing but its own name and weight:
when a weight changes, rows move only into or out of that child's subtree.

Growing by one shard hangs the new shard as a region and rack of its own, so
that no older weight changes and the new shard takes rows only into itself.

Law: ``key`` - the id and the tree (the shard count, for the default tree)
decide; sizes only balance in expectation.

Defined results
* a null id hashes as empty text; rows that repeat an id share a shard and get
  slots of their own;
* a null text has no bytes (size 1, CRC-32 0);
* slots are gapless from 0 in each shard, ordered by hash bucket, id, size
  and CRC; rows equal in all of these are interchangeable;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicegrid.llm.common import text_of


@dataclass(frozen=True)
class Node:
    """An inner node has children; a leaf has a shard number and a weight."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight

    def leaves(self) -> list["Node"]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def leaf(shard: int, weight: float = 1.0) -> Node:
    if not weight > 0:
        raise ValueError("a weight is above 0")
    return Node(f"shard{shard}", shard=shard, own_weight=weight)


def regular_tree(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> Node:
    """Shards 0..n-1 of equal weight, filled rack by rack and region by region."""
    racks = [Node(f"rack{i // per_rack}", tuple(leaf(s) for s in range(i, min(i + per_rack, shards))))
             for i in range(0, shards, per_rack)]
    regions = [Node(f"region{i // racks_per_region}", tuple(racks[i:i + racks_per_region]))
               for i in range(0, len(racks), racks_per_region)]
    return Node("root", tuple(regions))


def add_shard(tree: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region and rack of its own."""
    shard = 1 + max(x.shard for x in tree.leaves())
    branch = Node(f"region-of-{shard}", (Node(f"rack-of-{shard}", (leaf(shard, weight),)),))
    return Node(tree.name, (*tree.children, branch))


def _wait(key: Column, child: Node) -> Column:
    """Exponential waiting time of a child: -ln(u) / weight, u from 52 bits of MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(child.name + ":"), key).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2 ** 52))) / F.lit(float(child.weight))


def place(key: Column, tree: Node) -> Column:
    """The shard of a key: descend to the child with the shortest wait (ties: by name)."""
    if tree.shard is not None:
        return F.lit(tree.shard)
    if len(tree.children) == 1:
        return place(key, tree.children[0])
    kids = sorted(tree.children, key=lambda c: c.name)
    first = F.array_min(F.array(*[F.struct(_wait(key, c).alias("w"), F.lit(i).alias("i")) for i, c in enumerate(kids)]))["i"]
    out = place(key, kids[-1])
    for i in reversed(range(len(kids) - 1)):
        out = F.when(first == i, place(key, kids[i])).otherwise(out)
    return out


def shard_rows(docs: DataFrame, tree: Node, grown: Node | None = None, buckets: int = 256) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Slots are numbered without one task per shard: rows are counted by
    (shard, bucket of the id's hash), the counts - at most shards x buckets
    rows - are summed up to offsets, and a window numbers the rows of one
    bucket.  Raise ``buckets`` with the input (a bucket is one window group).
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text_of().alias("body"), key.alias("key")).select(
        "doc_id",
        (F.octet_length("body") + 1).cast("long").alias("size"),
        F.crc32(F.col("body").cast("binary")).alias("text_crc32"),
        place(F.col("key"), tree).cast("int").alias("shard"),
        (place(F.col("key"), grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("at", F.row_number().over(inside))
    # At most shards x buckets rows: a proven bound.
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("at") - 1).alias("slot"), "grown_shard")
