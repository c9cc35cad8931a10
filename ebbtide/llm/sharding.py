"""Sharding by a hierarchical weighted hash tree: region, rack, shard, each level drawn by the document's id.

At each level a child wins by the smallest ``-ln(u) / weight``, where ``u`` is a hash of the id and the child's name. A
child whose weight grows only draws ids to itself, and one whose weight falls only gives ids away; nothing moves
between the others, so a change of weights moves rows only into or out of the subtrees that it touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import number_rows

LAW = "key"
SHARDS_A_RACK, RACKS_A_REGION = 4, 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int) -> list[Leaf]:
    """A tree of equal weights, filled rack by rack and region by region."""
    per_region = SHARDS_A_RACK * RACKS_A_REGION
    return [Leaf(i // per_region, i // SHARDS_A_RACK, i) for i in range(shards)]


def grow(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own.

    In a region that has shards already, the larger weight of the region would draw ids to those as well. With its own,
    the only subtree whose weight changes is the new one, so rows move into the new shard and nowhere else.
    """
    new = [1 + max((getattr(leaf, level) for leaf in leaves), default=-1) for level in ("region", "rack", "shard")]
    return [*leaves, Leaf(*new, weight)]


def _uniform(key: Column, level: str, child: int) -> Column:
    """A number in (0, 1) from the id and the child's name."""
    hashed = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 11)
    return (hashed.cast("double") + 0.5) / F.lit(float(1 << 53))


def _draw(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The child that wins at a level; of equal draws (one in 2**53) the smaller child."""
    usable = sorted((child, weight) for child, weight in weights.items() if weight > 0)
    if len(usable) == 1:
        return F.lit(usable[0][0])
    draws = [
        F.struct((-F.log(_uniform(key, level, child)) / F.lit(weight)).alias("d"), F.lit(child).alias("child"))
        for child, weight in usable
    ]
    return F.array_min(F.array(*draws))["child"]


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of ``key``: the region is drawn first, then a rack in it, then a shard in that."""

    def totals(level: str, own: list[Leaf]) -> dict[int, float]:
        out: dict[int, float] = {}
        for leaf in own:
            out[getattr(leaf, level)] = out.get(getattr(leaf, level), 0.0) + leaf.weight
        return out

    def choose(level: str, own: list[Leaf], below) -> Column:
        weights = totals(level, own)
        drawn, out = _draw(key, level, weights), None
        for child in sorted(c for c, w in weights.items() if w > 0):
            found = below([leaf for leaf in own if getattr(leaf, level) == child])
            out = F.when(drawn == child, found) if out is None else out.when(drawn == child, found)
        return out

    return choose(
        "region", leaves, lambda own: choose("rack", own, lambda rest: _draw(key, "shard", totals("shard", rest)))
    )


def place(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1, ``slot`` counts from 0 without gaps within a shard,
    ``grown_shard`` is the shard in the tree ``grown`` (null without one). The id alone decides, so a repeated row goes
    to the same shard with a slot of its own, and rows without an id share a shard. Columns of ``docs`` other than
    ``doc_id`` and ``text`` play no part. An empty table gives an empty one. Texts are read whole but never moved.
    """
    key = docs["doc_id"]
    text = F.coalesce(docs["text"], F.lit(""))
    placed = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        shard_of(key, leaves).alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    numbered = number_rows(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", "shards")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard")


def read_shard(docs: DataFrame, leaves: list[Leaf], shard: int) -> DataFrame:
    """The rows of ``docs`` that belong to one shard, found without a shuffle."""
    return docs.filter(shard_of(docs["doc_id"], leaves) == shard)
