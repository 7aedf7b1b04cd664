"""A Merkle tree over the rows of a table, with a proof for every row.

Rows are leaves; the leaves of a group (a language) form a tree in the order of
their id, and the roots of the groups form one more tree in the order of the groups.
Each level is built by a self-join: a node's siblings are found by an equijoin on
their computed index, ``index XOR 1`` in a binary tree, the slot offsets otherwise.
The nodes in slot zero then emit the parents.  A last run may be short, even one node;
its parent is the hash of what there is.

Proofs are made from the top down: a node's path is what stands left and right of
it among its siblings, before its parent's path.  A path holds one entry a level, so
it grows with the logarithm of the number of rows.

A group with a third of all rows is no hot key: leaves are dealt by ranges of
(group, id), joins by (group, index).  No list of groups or nodes is gathered.

Values: a leaf is the hash of the row's fields, each ``-`` if null and else the
number of its UTF-8 bytes, ``:`` and the text; a digest goes into further hashes as
lowercase hexadecimal text.  A null group is a group of its own and the first.  A null id comes
first in its group; rows of equal id are ordered by their leaf, so repeated rows
have neighbouring places and equal leaves.  Empty and very long texts are hashed
whole.  Further columns are never read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept, width

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """SHA-256 of texts put together, as bytes."""
    return F.unhex(F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256))


def hexed(value: Column) -> Column:
    """Bytes as lowercase hexadecimal text."""
    return F.lower(F.hex(value))


def leaf(fields: list[Column]) -> Column:
    """Hash of a row's fields; the byte counts keep neighbouring fields apart."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``index`` (from zero, by ``order`` within ``group``) and ``size`` of the group, without one task for a group.

    Rows are dealt by ranges of (group, order) and sorted; a row's index is its place in its range
    after the rows of the group in earlier ranges.
    """
    parts = width(rows.sparkSession)
    dealt = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    placed = kept(dealt.withColumn("place", F.monotonically_increasing_id()), "placed")
    ranges = placed.groupBy(group, F.shiftright("place", 33).alias("range")).agg(F.min("place").alias("begin"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        group, "range", "begin", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy(group)).alias("size")
    )
    joined = placed.withColumn("range", F.shiftright("place", 33)).join(starts, [group, "range"])
    return joined.withColumn("index", F.col("place") - F.col("begin") + F.col("before")).drop("place", "range", "begin", "before")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Add ``left`` and ``right``: the hashes of the siblings on either side, put together in order (null where there is none)."""
    slot = F.col("index") % arity
    if arity == 2:
        other = nodes.select("tree", F.expr("index ^ 1").alias("index"), F.col("hash").alias("other"))
        joined = nodes.join(other, ["tree", "index"], "left")
        return joined.withColumn("left", F.when(slot == 1, F.col("other"))).withColumn("right", F.when(slot == 0, F.col("other"))).drop("other")
    offset = F.explode(F.sequence(F.lit(1), F.lit(arity - 1)))
    sent = nodes.select("tree", "index", "hash", slot.alias("slot"), offset.alias("offset")).select(
        "tree", (F.col("index") - F.col("slot") + (F.col("slot") + F.col("offset")) % arity).alias("index"), F.struct("slot", "hash").alias("other")
    )
    others = sent.groupBy("tree", "index").agg(F.array_sort(F.collect_list("other")).alias("others"))  # at most arity - 1

    def side(test) -> Column:
        chosen = F.transform(F.filter("others", lambda o: test(o["slot"])), lambda o: hexed(o["hash"]))
        return F.when(F.size(chosen) > 0, F.unhex(F.array_join(chosen, "")))

    joined = nodes.join(others, ["tree", "index"], "left")
    return joined.withColumn("left", side(lambda s: s < slot)).withColumn("right", side(lambda s: s > slot)).drop("others")


def combined(left: Column, own: Column, right: Column) -> Column:
    """The parent's hash: the run of siblings from left to right."""
    return digest(F.coalesce(hexed(left), F.lit("")), hexed(own), F.coalesce(hexed(right), F.lit("")))


ENTRY = "array<struct<left: binary, right: binary>>"


class Tree:
    """Trees over ``nodes`` (tree, index, size, hash, and what a leaf carries along), one per value of ``tree``.

    ``levels[k]`` holds the nodes of level ``k`` in trees that go on beyond it, with
    their siblings; ``roots`` has (tree, height, hash).
    """

    def __init__(self, nodes: DataFrame, arity: int = 2):
        self.nodes, self.arity, self.levels = nodes, arity, []
        largest = nodes.agg(F.max("size")).first()[0] or 0
        roots = [nodes.where("size = 1").select("tree", F.lit(0).alias("height"), "hash")]
        level = nodes
        while largest > 1:
            joined = kept(with_siblings(level.where("size > 1"), arity), f"level-{len(self.levels)}")
            self.levels.append(joined)
            parents = joined.where(F.col("index") % arity == 0).select(
                "tree", F.expr(f"index div {arity}").alias("index"), F.expr(f"(size + {arity - 1}) div {arity}").alias("size"), combined(F.lit(None).cast("binary"), F.col("hash"), F.col("right")).alias("hash")
            )
            roots.append(parents.where("size = 1").select("tree", F.lit(len(self.levels)).alias("height"), "hash"))
            level, largest = parents, -(-largest // arity)
        while len(roots) > 1:  # pairwise, so that the plan stays flat
            roots = [a.unionByName(b) for a, b in zip(roots[::2], roots[1::2])] + ([roots[-1]] if len(roots) % 2 else [])
        self.roots = kept(roots[0], "roots")

    def paths(self, above: DataFrame, carried: list[str]) -> DataFrame:
        """The leaves with their ``path`` to the root of all and what ``above`` (tree, path, ...) has for their tree."""
        extra = [c for c in above.columns if c not in ("tree", "path")]
        tops = kept(self.roots.select("tree", "height").join(above, "tree").withColumn("index", F.lit(0).cast("long")), "tops")
        entry = F.array(F.struct("left", "right"))
        parents: DataFrame | None = None
        for k in range(len(self.levels) - 1, -1, -1):
            begun = tops.where(F.col("height") == k + 1).select("tree", "index", "path", *extra)
            ups = begun if parents is None else begun.unionByName(parents)
            ups = ups.select(F.col("tree"), F.col("index").alias("up"), "path", *extra)
            level = self.levels[k].withColumn("up", F.expr(f"index div {self.arity}"))
            joined = level.join(ups, ["tree", "up"]).withColumn("path", F.concat(entry, F.col("path")))
            parents = joined.select("tree", "index", "path", *extra, *(carried if k == 0 else []))
            if k and k % 6 == 0:
                parents = kept(parents, f"paths-{k}")
        alone = self.nodes.where("size = 1").select("tree", *carried).join(tops.where("height = 0").select("tree", "index", "path", *extra), "tree")
        return alone if parents is None else parents.unionByName(alone)


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf's hash leads to along its path."""
    return F.aggregate(path, start, lambda h, e: combined(e["left"], h, e["right"]))


def proof(path: str = "path") -> Column:
    """Hash of the siblings along a path, level by level, left to right."""
    sides = F.transform(path, lambda e: F.concat(F.coalesce(hexed(e["left"]), F.lit("")), F.coalesce(hexed(e["right"]), F.lit(""))))
    return F.sha2(F.array_join(sides, ""), 256)


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = 2) -> DataFrame:
    """Every row's ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``tampered`` says which rows to check with one more in ``n_chars`` than the tree was built over.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = [F.col("n_chars").cast("long") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    claimed = F.lit(None).cast("binary") if tampered is None else F.when(tampered & F.col("n_chars").isNotNull(), leaf(changed))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))  # null sorts before all names
    hashed = docs.select("doc_id", tree.alias("tree"), leaf(fields).alias("hash"), claimed.alias("claimed"))
    leaves = kept(hashed.withColumn("row", F.monotonically_increasing_id()), "leaves")  # many equal rows still fall into many ranges
    by_group = Tree(kept(numbered(leaves, "tree", ["doc_id", "hash", "row"]).drop("row"), "nodes"), arity)

    ranked = numbered(by_group.roots.select(F.col("tree").alias("group"), "hash").withColumn("tree", F.lit("")), "tree", ["group"])
    of_groups = Tree(kept(ranked, "group-nodes"), arity)
    top = of_groups.roots.select("tree", F.col("hash").alias("root")).withColumn("path", F.array().cast(ENTRY))
    groups = of_groups.paths(top, ["group", "hash"]).select(F.col("group").alias("tree"), "path", "root", F.col("hash").alias("subroot"))

    rows = by_group.paths(kept(groups, "groups"), ["doc_id", "hash", "claimed"])
    out = rows.withColumn("folded", folded(F.coalesce("claimed", "hash")))
    return out.select(
        "doc_id",
        hexed(F.col("hash")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        "path",
        proof().alias("proof_sha256"),
        hexed(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
