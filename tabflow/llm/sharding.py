"""Sharding by a hierarchical weighted hash tree.

A document descends from the root through region and rack to a shard.  At
each node every child draws an exponential arrival time from a hash of the
child's name and the document's id, divided by the child's weight (the sum
of its shards' weights); the earliest child wins.  A child's draws do not
depend on its siblings, so if weights change, documents move only into or
out of subtrees whose weights changed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.scratch import Scratch

#: Columns that ``place`` adds.
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")

#: region -> rack -> shard -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2) -> Tree:
    """``shards`` equal shards, racks and regions filled in order."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for s in range(shards):
        rack = s // shards_per_rack
        region = rack // racks_per_region
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """``tree`` with one more shard in a rack and region of its own.  No old
    subtree's weight changes, so documents move only into the new shard."""
    name = f"added{shard}"
    return {**tree, name: {name: {shard: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, Mapping) else float(node)


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard of a key (null counts as one key).  Children of weight 0 get nothing."""

    def descend(node, path: str) -> Column:
        live = [(name, child) for name, child in node.items() if _weight(child) > 0]
        below = [descend(child, f"{path}/{name}") if isinstance(child, Mapping) else F.lit(int(name)) for name, child in live]
        if len(below) == 1:
            return below[0]
        draws = []
        for i, (name, child) in enumerate(live):
            u = (F.pmod(F.xxhash64(F.lit(f"{path}/{name}"), key), F.lit(1 << 52)) + 0.5) / float(1 << 52)
            draws.append(F.struct((-F.log(u) / _weight(child)).alias("t"), F.lit(i).alias("i")))
        won = F.array_min(F.array(*draws))["i"]
        out = below[-1]
        for i in range(len(below) - 2, -1, -1):
            out = F.when(won == i, below[i]).otherwise(out)
        return out

    if _weight(tree) <= 0:
        raise ValueError("the tree has no shard of positive weight")
    return descend(tree, "").cast("int")


def kept_names(columns: Sequence[str]) -> dict[str, str]:
    """Names under which ``place`` keeps input columns: the same, but ``input_``
    goes before a name that it adds or uses inside, as often as needed."""
    taken = {*ADDED, "_row", "_task", "_first", "_start"}
    names: dict[str, str] = {}
    for c in sorted(columns, key=lambda c: c.lower() in taken):
        new = c
        while new.lower() in taken:
            new = f"input_{new}"
        taken.add(new.lower())
        names[c] = new
    return {c: names[c] for c in columns}


def place(docs: DataFrame, tree: Tree | None = None, more: Sequence[int] = (8,), keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``size, text_crc32, law, shard, slot, grown_shard`` added.

    Law ``key``: the id and the tree decide, so rows with one id, null
    included, share a shard.  ``grown_shard`` is the shard once the shards
    ``more`` have been added.  Size is the text's UTF-8 bytes plus 1 (null: 1;
    its crc32 is null).  ``slot`` numbers a shard's rows from 0 in input
    order: rows are sorted by shard within each scan task as they are written,
    so a row's number there less that of its shard's first, shifted by the
    counts of the tasks before, is its slot.  No row is shuffled for it and no
    task holds a shard.  All columns of ``docs`` stay, or those of ``keep``;
    one whose name is among the added ones is renamed (see ``kept_names``).
    """
    tree = tree or even_tree(8)
    wide = tree
    for s in more:
        wide = grown(wide, s)
    tmp = Scratch(docs.sparkSession, "sharding")
    data, key = F.col("text").cast("binary"), F.col("doc_id").cast("string")
    names = kept_names(docs.columns if keep is None else keep)
    rows = docs.select(
        *[F.col(f"`{old}`").alias(new) for old, new in names.items()],
        (F.coalesce(F.length(data), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(key, tree).alias("shard"), shard_of(key, wide).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_task")).sortWithinPartitions("shard", "_task")
    rows = tmp.save(rows.drop("_task").withColumn("_row", F.monotonically_increasing_id()), "rows")
    rows = rows.withColumn("_task", F.shiftright("_row", 33))
    runs = rows.groupBy("shard", "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    ahead = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("shard", "_task", "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))  # one row a shard and task
    slot = (F.col("_row") - F.col("_first") + F.col("_start")).cast("long")
    return rows.join(starts, ["shard", "_task"]).select(*[f"`{c}`" for c in names.values()], "size", "text_crc32", "law", "shard",
                                                        slot.alias("slot"), "grown_shard")
