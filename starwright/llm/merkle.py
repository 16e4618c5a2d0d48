"""A Merkle manifest of a dataset: one tree per group of rows, one over the groups' roots.

Nodes are numbered in their order, without a window over a group, and cut into aligned blocks
of ``BLOCK`` nodes.  A block keeps each of its levels as one string of hexadecimal digests, end
to end: a parent is the hash of a fixed-width substring, and what stands to the left and right
of a node within its run is its sibling segment on that level.  A block ends in one digest; the
blocks' digests are the nodes of the next tier, until a group is a single block.  The roots of
the groups are the nodes of one more such tree.

Everything is a SQL expression.  A task holds a block (some 100 kB), never a group, so a group
with a third of all rows is as many blocks as it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.llm.common import lookup_join, materialize, stored

DIGEST, FAN = 64, 8
RUN = FAN * DIGEST
TIER_LEVELS = 3
BLOCK = FAN**TIER_LEVELS
_STAMP_BITS = 33

DOCUMENT = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``-`` for null, else its bytes, a colon and itself."""
    texts = [value.cast("string") for value in values]
    return hashed(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]))


def group_name(group: Column) -> Column:
    """A text per group that is never null and sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(nodes: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``nodes`` with ``place``, from 0 in the order of its group, and ``size`` of the group.

    Rows are range-partitioned and written with a stamp, so one count per partition and group
    turns stamps into places.  ``order`` must tell any two rows of a group apart, or rows it
    does not may stand in either order.
    """
    ranged = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    written = stored(ranged.withColumn("stamp", F.monotonically_increasing_id()), label)
    written = written.withColumn("range", F.shiftright("stamp", _STAMP_BITS))
    spans = written.groupBy("tree", "range").agg(
        F.count(F.lit(1)).alias("n"), F.min("stamp").alias("first")
    )
    whole = Window.partitionBy("tree")
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        spans.select(
            "tree", "range",
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(whole).alias("size"),
        ),
        f"{label}-offsets",
    )
    return (
        lookup_join(written, offsets, ["tree", "range"])
        .withColumn("place", F.col("stamp") + F.col("shift"))
        .drop("stamp", "range", "shift")
    )


def parents(level: Column) -> Column:
    """The level above: a digest per run of nodes, whole or not."""
    runs = F.ceil(F.length(level) / F.lit(RUN)).cast("int")
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), runs - 1),
            lambda run: hashed(F.substring(level, run * RUN + 1, F.lit(RUN))),
        ),
        "",
    )


def siblings(level: Column, at: Column) -> Column:
    """What stands left and right of node ``at`` in its run."""
    run, inside = F.floor(at / FAN).cast("int"), at % FAN
    return F.struct(
        F.substring(level, run * RUN + 1, inside * DIGEST).alias("left"),
        F.substring(level, (at + 1) * DIGEST + 1, F.lit(RUN - DIGEST) - inside * DIGEST).alias(
            "right"
        ),
    )


def block_levels(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """A row per block: ``tree, block, size, depth, entries, level_0 … level_3, top``.

    ``depth`` is the number of levels that the block hashes: three, but fewer in a group that is
    a single block.
    """
    size = F.col("size")
    depth = reduce_sum([(size > FAN**level).cast("int") for level in range(TIER_LEVELS)])
    blocks = (
        nodes.groupBy(
            "tree", "size", F.floor(F.col("place") / F.lit(BLOCK)).cast("long").alias("block")
        )
        .agg(F.sort_array(F.collect_list(F.struct("place", "node", *payload))).alias("entries"))
        .withColumn("depth", depth)
        .withColumn("level_0", F.array_join("entries.node", ""))
    )
    top = F.col("level_0")
    for level in range(1, TIER_LEVELS + 1):
        above = F.when(F.col("depth") >= level, parents(F.col(f"level_{level - 1}")))
        blocks = blocks.withColumn(f"level_{level}", above)
        top = F.coalesce(F.col(f"level_{level}"), top)
    return blocks.withColumn("top", top)


def reduce_sum(columns: Sequence[Column]) -> Column:
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    return total


@dataclass(frozen=True)
class Forest:
    """Trees as written tiers of blocks, lowest first, and ``tree, root`` of each."""

    tiers: list[DataFrame]
    payload: tuple[str, ...]

    @property
    def roots(self) -> DataFrame:
        tops = [tier.where(F.col("size") <= BLOCK).select("tree", "top") for tier in self.tiers]
        found = tops[0]
        for more in tops[1:]:
            found = found.unionByName(more)
        return found.withColumnRenamed("top", "root")

    def paths(self, above: DataFrame) -> DataFrame:
        """A row per lowest node: ``tree, place, node``, payload, ``path`` and columns of ``above``.

        ``above`` has ``tree`` and ``path``, the siblings from the tree's root on.  ``path`` lists
        ``left, right`` from the node up.
        """
        carried = [c for c in above.columns if c not in ("tree", "path")]
        start = above.withColumn("block", F.lit(0).cast("long"))
        from_above: DataFrame | None = None
        for number in range(len(self.tiers) - 1, -1, -1):
            tier = self.tiers[number]
            # A tree of one block takes the path above the tree, other blocks that of their node.
            single = tier.where(F.col("size") <= BLOCK).join(start, ["tree", "block"])
            rows = single
            if from_above is not None:
                several = tier.where(F.col("size") > BLOCK).join(from_above, ["tree", "block"])
                rows = single.unionByName(several)
            nodes = _with_paths(rows, carried)
            if number == 0:
                return nodes.select("tree", "entry.*", "path", *carried)
            from_above = materialize(
                nodes.select("tree", F.col("entry.place").alias("block"), "path", *carried),
                "merkle-paths",
            )
        raise ValueError("a forest has a tier")


def _with_paths(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """A row per node of each block: ``tree, entry, path`` and what is ``carried``."""

    def climb(entry: Column) -> Column:
        at = (entry["place"] % BLOCK).cast("int")
        own = F.array(*[
            F.when(
                F.col("depth") > level,
                siblings(F.col(f"level_{level}"), F.floor(at / FAN**level).cast("int")),
            )
            for level in range(TIER_LEVELS)
        ])
        return F.struct(entry.alias("entry"), F.slice(own, F.lit(1), F.col("depth")).alias("own"))

    return blocks.select(
        "tree", F.explode(F.transform("entries", climb)).alias("n"), "path", *carried
    ).select("tree", "n.entry", F.concat("n.own", "path").alias("path"), *carried)


def grow(nodes: DataFrame, payload: Sequence[str] = ()) -> Forest:
    """Trees over ``tree, place, size, node`` and the payload that the lowest entries keep.

    Each tier has a row for ``BLOCK`` of the tier below, so their number is a logarithm.
    """
    tiers = []
    kept = tuple(payload)
    while True:
        tier = stored(block_levels(nodes, kept if not tiers else ()), f"merkle-tier{len(tiers)}")
        tiers.append(tier)
        nodes = tier.where(F.col("size") > BLOCK).select(
            "tree", F.col("block").alias("place"),
            F.ceil(F.col("size") / F.lit(BLOCK)).cast("long").alias("size"),
            F.col("top").alias("node"),
        )
        if nodes.isEmpty():
            return Forest(tiers, kept)


@dataclass(frozen=True)
class Manifest:
    """The trees of a dataset: one per group, and the one over the groups' roots."""

    groups: Forest
    crown: Forest

    @property
    def root(self) -> str | None:
        """Root of the dataset; None for one without rows."""
        found = self.crown.roots.first()
        return found.root if found else None

    def proofs(self) -> DataFrame:
        """A row per leaf: ``doc_id, leaf, claimed, subroot, root, path``."""
        none = F.array().cast("array<struct<left:string,right:string>>")
        trees = self.crown.roots.select("tree", none.alias("path"))
        above = self.crown.paths(trees).select(
            F.col("name").alias("tree"), "path", F.col("node").alias("subroot"),
            F.lit(self.root).alias("root"),
        )
        return self.groups.paths(materialize(above, "merkle-crown")).select(
            "doc_id", F.col("node").alias("leaf"), "claimed", "subroot", "root", "path"
        )


def build(
    docs: DataFrame, fields: Sequence[str] = DOCUMENT, id_col: str = "doc_id",
    group_col: str = "lang", claims: Mapping[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: every row is a leaf over ``fields``, a tree per ``group_col``.

    Leaves of a group ascend by id, null ids first; rows that share an id stand by their leaf,
    and repeated rows are leaves of their own.  ``claims`` gives other values of fields for a
    copy of the data that is to be verified: the leaf of the copy is kept as ``claimed``.
    A null group is a group of its own, the first.  Texts are hashed whole, whatever their
    length.  An empty table has no leaf and the root None.  Other columns are left out.
    """
    leaf = leaf_of([F.col(f) for f in fields])
    claims = claims or {}
    same = F.lit(True)
    for name, value in claims.items():
        same = same & value.eqNullSafe(F.col(name))
    claimed = leaf_of([claims.get(f, F.col(f)) for f in fields])
    leaves = stored(
        docs.select(
            group_name(F.col(group_col)).alias("tree"), F.col(id_col).alias("doc_id"),
            leaf.alias("node"), F.when(~same, claimed).alias("claimed"),
            # Tells equal rows apart, so that ranges can part them.
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    leaves = leaves.withColumn("claimed", F.coalesce("claimed", "node"))
    numbered = placed(leaves, ["doc_id", "node", "row"], "merkle-leaves-placed")
    groups = grow(numbered, ["doc_id", "claimed"])
    named = groups.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node")
    )
    crown = grow(placed(named, ["name"], "merkle-roots-placed"), ["name"])
    return Manifest(groups, crown)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(
        path, leaf, lambda node, level: hashed(F.concat(level["left"], node, level["right"]))
    )


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(
        F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""
    )


def verify(proofs: DataFrame) -> DataFrame:
    """Proofs with ``proof_sha256``, ``folded_root`` of the claimed leaf, and ``verified``."""
    return (
        proofs.withColumn("proof_sha256", hashed(proof_text(F.col("path"))))
        .withColumn("folded_root", folded(F.col("claimed"), F.col("path")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
