"""A Merkle tree over a dataset: one subtree per group, and a proof for every row.

An aligned block of nodes keeps each of its levels as one string of hexadecimal digests.
A parent is the hash of a fixed-width substring, and what flanks a node in that substring
are its siblings. The tops of blocks are the nodes of the next tier, until one is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch
from touchline.llm.ranks import ranked

#: Children of a node, levels of a block, and digits of a digest.
ARITY, LEVELS, DIGITS = 8, 3, 64
BLOCK, RUN = ARITY**LEVELS, ARITY * DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree whose leaves are the roots of all others.
FOREST = "forest"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(values: Sequence[Column]) -> Column:
    """The digest of a row: every value with its length in bytes, so that none runs into the next."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*map(field, values)))


def _parents(level: Column) -> Column:
    """The next level: one digest for every run of ARITY nodes, the last run may be shorter."""
    last = F.ceil(F.length(level) / F.lit(RUN)).cast("int") - 1
    nodes = F.transform(
        F.sequence(F.lit(0), last), lambda i: digest(F.substring(level, i * RUN + 1, F.lit(RUN)))
    )
    return F.array_join(nodes, "")


def _blocks(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """The aligned blocks of ``nodes`` (tree, place, total, node, what): tree, block, total,
    rows (place, node, what), level0 to level2, depth (levels to climb) and top.

    A block has BLOCK rows at most, whatever the size of its tree.
    """
    depth = F.when(F.col("total") <= 1, 0)
    for level in range(1, LEVELS):
        depth = depth.when(F.col("total") <= ARITY**level, level)
    blocks = (
        nodes.groupBy("tree", F.floor(F.col("place") / F.lit(BLOCK)).alias("block"))
        .agg(
            F.max("total").alias("total"),
            F.array_sort(F.collect_list(F.struct("place", "node", "what"))).alias("rows"),
        )
        .withColumn("depth", depth.otherwise(LEVELS))
        .withColumn("level0", F.array_join(F.col("rows.node"), ""))
    )
    for level in range(1, LEVELS + 1):
        below = F.col(f"level{level - 1}")
        blocks = blocks.withColumn(f"level{level}", F.when(F.col("depth") >= level, _parents(below)))
    top = F.coalesce(*[F.col(f"level{level}") for level in range(LEVELS, -1, -1)])
    return scratch.write(blocks.withColumn("top", top).drop(f"level{LEVELS}"))


def _tiers(nodes: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """The blocks of every tier; the tops of a tier are the nodes of the next one."""
    tiers = []
    while True:
        tiers.append(_blocks(nodes, scratch))
        nodes = (
            tiers[-1]
            .filter(F.col("total") > BLOCK)
            .select(
                "tree",
                F.col("block").alias("place"),
                F.ceil(F.col("total") / F.lit(BLOCK)).alias("total"),
                F.col("top").alias("node"),
                F.lit(None).cast("string").alias("what"),
            )
        )
        if nodes.isEmpty():
            return tiers


def _siblings(place: Column) -> Column:
    """What stands left and right of a node, and of its ancestors within the block."""

    def beside(level: int) -> Column:
        at = F.floor(F.pmod(place, F.lit(BLOCK)) / F.lit(ARITY**level)).cast("int")
        inside = F.pmod(at, F.lit(ARITY))
        run = F.substring(f"level{level}", (at - inside) * DIGITS + 1, F.lit(RUN))
        return F.struct(
            F.substring(run, F.lit(1), inside * DIGITS).alias("left"),
            F.substring(run, inside * DIGITS + DIGITS + 1, F.lit(RUN)).alias("right"),
        )

    return F.slice(F.array(*map(beside, range(LEVELS))), F.lit(1), F.col("depth"))


def _paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """tree, block and path of the first tier's blocks: the siblings of a block's top and of
    all that stands over it. ``above`` has the path of every tree's own top, by tree.
    """
    path = None
    for tier, blocks in reversed(list(enumerate(tiers))):
        own = blocks.select("tree", "block", "total")
        ends = own.filter(F.col("total") <= BLOCK).join(above, "tree").select("tree", "block", "path")
        if path is None:
            path = ends
            continue
        over = tiers[tier + 1].join(path, ["tree", "block"]).withColumnRenamed("block", "over")
        inner = (
            own.filter(F.col("total") > BLOCK)
            .withColumn("over", F.floor(F.col("block") / F.lit(BLOCK)))
            .drop("total")
            .join(over, ["tree", "over"])
            .select("tree", "block", F.concat(_siblings(F.col("block")), "path").alias("path"))
        )
        path = inner.unionByName(ends)
    return path


def build_manifest(
    docs: DataFrame,
    scratch: Scratch,
    fields: Sequence[str] = FIELDS,
    tree: str = "lang",
    key: str = "doc_id",
    claimed: dict[str, Column] | None = None,
) -> DataFrame:
    """The key, leaf, subroot, root, proof, folded_root and verified of every row.

    A row's leaf is the digest of its ``fields``. The leaves of each value of ``tree`` (null
    is one, the first) stand by ``key``, nulls first and ties by leaf; every ARITY of them
    make a parent until one node, the subroot, is left. Subroots, by the bytes of ``tree``,
    make the root in the same way. ``proof`` holds the left and right siblings from leaf to
    root. ``claimed`` replaces fields by what is claimed to be in them: the leaf of that is
    folded with the proof, and ``verified`` tells whether the root comes out.

    Repeated rows are leaves of their own; an empty table gives no rows. Columns other
    than the fields, ``tree`` and ``key`` are ignored, whatever their names.
    """
    told = [F.col(name) for name in fields]
    leaf = leaf_of(told)
    other = leaf_of([(claimed or {}).get(name, F.col(name)) for name in fields])
    # "" stands for null and sorts before all values, which are marked.
    named = F.coalesce(F.concat(F.lit("+"), F.col(tree).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), named.alias("tree"), leaf.alias("node"), other.alias("other")
    )
    placed = ranked(rows, ["key", "node"], scratch, "tree")
    tiers = _tiers(
        placed.select("tree", "place", "total", "node", F.struct("key", "other").alias("what")), scratch
    )
    subroots = tiers[0].filter(F.col("total") <= BLOCK).select("tree", "top")
    for blocks in tiers[1:]:
        subroots = subroots.unionByName(blocks.filter(F.col("total") <= BLOCK).select("tree", "top"))

    roots = ranked(subroots, ["tree"], scratch).select(
        F.lit(FOREST).alias("tree"), "place", "total", F.col("top").alias("node"), F.col("tree").alias("what")
    )
    forest = _tiers(roots, scratch)
    root = forest[-1].filter(F.col("total") <= BLOCK).select("top").scalar()
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    top_path = forest[-1].select("tree").distinct().withColumn("path", nothing)
    over = scratch.write(
        forest[0]
        .join(_paths(forest, top_path), ["tree", "block"])
        .withColumn("row", F.explode("rows"))
        .select(
            F.col("row.what").alias("tree"),
            F.col("row.node").alias("subroot"),
            F.concat(_siblings(F.col("row.place")), "path").alias("path"),
        )
    )
    paths = _paths(tiers, over.select("tree", "path")).join(over.select("tree", "subroot"), "tree")

    def folded(start: Column, path: Column) -> Column:
        return F.aggregate(path, start, lambda node, x: digest(F.concat(x["left"], node, x["right"])))

    def answer(row: Column) -> Column:
        proof = F.concat(_siblings(row["place"]), F.col("path"))
        return F.struct(
            row["what"]["key"].alias(key),
            row["node"].alias("leaf"),
            proof.alias("proof"),
            folded(row["what"]["other"], proof).alias("folded_root"),
        )

    answers = (
        tiers[0]
        .join(paths, ["tree", "block"])
        .select("subroot", F.explode(F.transform("rows", answer)).alias("row"))
    )
    return answers.select("row.*", "subroot", root.alias("root")).select(
        key, "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, from leaf to root and left to right."""
    return digest(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), ""))
