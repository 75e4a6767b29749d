"""Merkle manifest of a data set: a tree of digests per group of rows and one over the groups, with a proof for every row.

A leaf is the SHA-256 of a row's fields.  Inside a group the leaves are numbered
in the order of their ids; a parent is the digest of its children's digests, put
one after the other.  The groups' roots are the leaves of the tree on top.

Slot pivot: conditional aggregates spread the nodes below a parent into columns,
one for each slot; concatenating a run of columns and hashing it gives the
parent, and the same run without a node's own column gives its siblings.  One
aggregate spreads SLOTS columns, so it climbs several levels (four for a fanout
of two) and each row of nodes is shuffled once.  Proofs come down the same way:
a parent's row holds its path to the root once, and its slots become rows that
put their siblings before it.  The way up moves SLOTS times fewer rows with every
pass; neither direction brings a group to one task.

The numbering is distributed: leaves are range-partitioned by (group, id, digest),
sorted, checkpointed, and a group's rows in earlier partitions are added to a
row's place in its own.  Everything built on it reads the checkpoint, so a lost
executor recomputes digests from stored rows in the stored order.

Defined results: null is written `-`, any other value as its byte count, `:` and
the value; a null group is a group of its own, first in order; null ids come
first in their group and rows with equal ids follow each other by digest; rows
that repeat all fields are leaves of their own with equal digests; a group of one
row has its leaf as root; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.lookup import size_checked
from vitrine.session import ensure_checkpoint_dir

#: columns that one pivot spreads
SLOTS = 16
PATH = "array<struct<l:string,r:string>>"


@dataclass
class Tree:
    """Passes from the leaves up (each a table of pivoted runs), and the root of every group: grp, digest."""

    passes: list[DataFrame]
    levels: int
    fanout: int
    roots: DataFrame


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """A string that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str], fanout: int) -> DataFrame:
    """rows (with `grp`) and `pos`, the place from 0 in the group, and `height`, the levels above its leaves; checkpointed."""
    by = ["grp", *order, "__row"]  # the last one spreads equal rows over partitions
    placed = (rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("__row")
              .withColumn("__at", F.monotonically_increasing_id()).checkpoint())
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    runs = placed.groupBy("grp", "__part").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    # a group has at most one run in each partition
    own = Window.partitionBy("grp")
    before = F.sum("n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    powers = F.array(*[F.lit(fanout ** k).cast("long") for k in range(64) if fanout ** k < 1 << 62])
    runs = (runs.withColumn("shift", F.coalesce(before, F.lit(0)) - F.col("first")).withColumn("size", F.sum("n").over(own))
            .select("grp", "__part", "shift", F.size(F.filter(powers, lambda p: p < F.col("size"))).alias("height")).checkpoint())
    return (placed.join(size_checked(runs), ["grp", "__part"]).withColumn("pos", F.col("__at") + F.col("shift")).drop("__at", "__part", "shift"))


def build(leaves: DataFrame, fanout: int = 2) -> Tree:
    """leaves: grp, pos, height, digest, rider (anything that must come back with a leaf's path)."""
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    span = fanout ** levels
    top = leaves.agg(F.max("height")).first()[0] or 0
    passes, nodes = [], leaves
    for k in range(max(1, -(-top // levels))):
        spread = ["digest", "rider"] if k == 0 else ["digest"]
        table = nodes.groupBy("grp", "height", F.expr(f"pos div {span}").alias("pos")).agg(
            *[F.expr(f"max(CASE WHEN pos % {span} = {i} THEN {c} END) AS {'rider' if c == 'rider' else 'node_0'}_{i}") for c in spread for i in range(span)])
        for m in range(levels):
            table = table.selectExpr("*", *[f"{_parent([f'node_{m}_{j * fanout + i}' for i in range(fanout)], k * levels + m)} AS node_{m + 1}_{j}"
                                            for j in range(span // fanout ** (m + 1))])
        passes.append(table.checkpoint())
        nodes = passes[-1].select("grp", "height", "pos", F.col(f"node_{levels}_0").alias("digest"))
    return Tree(passes, levels, fanout, nodes.select("grp", "digest"))


def _parent(run: list[str], level: int) -> str:
    """Digest of a run of nodes of a level; the root of a lower tree is passed on."""
    return f"CASE WHEN height <= {level} THEN {run[0]} WHEN {run[0]} IS NOT NULL THEN sha2(concat_ws('', {', '.join(run)}), 256) END"


def _siblings(slot: int, tree: Tree, level: int) -> str:
    """What stands left and right of a slot's node in its run, level by level, while the node isn't the root."""
    steps = []
    for m in range(tree.levels):
        place, first = slot // tree.fanout ** m, slot // tree.fanout ** (m + 1) * tree.fanout
        left, right = (", ".join(["''", *(f"node_{m}_{j}" for j in part)]) for part in (range(first, place), range(place + 1, first + tree.fanout)))
        steps.append(f"CASE WHEN height > {level + m} THEN named_struct('l', concat_ws('', {left}), 'r', concat_ws('', {right})) END")
    return f"array_compact(array({', '.join(steps)}))"


def paths(tree: Tree, roots: DataFrame) -> DataFrame:
    """One row per leaf: rider, digest, path (siblings from the leaf up), and the columns of its group's row of roots.

    roots: grp, path (what lies above the group's root), and columns to carry.
    """
    span = tree.fanout ** tree.levels
    state, carried = roots.withColumn("pos", F.lit(0).cast("long")), [c for c in roots.columns if c not in ("grp", "path")]
    for k in reversed(range(len(tree.passes))):
        rider = [", 'rider', rider_{}", ""][k > 0]
        slots = ", ".join(f"named_struct('slot', {i}, 'digest', node_0_{i}, 'steps', {_siblings(i, tree, k * tree.levels)}{rider.format(i)})" for i in range(span))
        state = (tree.passes[k].join(state, ["grp", "pos"]).selectExpr("grp", "pos", "path", *carried, f"explode(array({slots})) AS s").where("s.digest IS NOT NULL")
                 .selectExpr("grp", f"pos * {span} + s.slot AS pos", "concat(s.steps, path) AS path", *carried, "s.digest", *(["s.rider"] if k == 0 else [])))
    return state.drop("grp", "pos")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.concat(step["l"], acc, step["r"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["l"], step["r"])), "")


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", fanout: int = 2,
             tampered: dict[str, Column] | None = None, tamper: Column | None = None) -> DataFrame:
    """One row per row of docs: id, leaf, subroot, root, path, folded_root, verified.

    tampered replaces fields where `tamper` holds; folded_root is what the changed
    row's leaf gives with the original siblings.  Both are columns over docs.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    values = {c: F.col(c) for c in fields}
    changed = F.when(tamper, row_digest(*(values | (tampered or {})).values())) if tamper is not None else F.lit(None).cast("string")
    rows = docs.select(group_key(F.col(group_col)).alias("grp"), row_digest(*values.values()).alias("digest"), F.col(id_col).alias("id"), changed.alias("changed")).checkpoint()
    leaves = numbered(rows, ["id", "digest"], fanout).withColumn("rider", F.struct("id", "changed"))
    tree = build(leaves, fanout)
    groups = numbered(tree.roots.select(F.lit("").alias("grp"), F.col("grp").alias("rider"), "digest"), ["rider"], fanout)
    top = build(groups, fanout)
    above = paths(top, top.roots.select("grp", F.col("digest").alias("root"), F.array().cast(PATH).alias("path")))
    below = paths(tree, above.select(F.col("rider").alias("grp"), F.col("digest").alias("subroot"), "root", "path"))
    return (below.select(F.col("rider.id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path",
                         folded(F.coalesce("rider.changed", "digest"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
