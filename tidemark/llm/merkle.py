"""Merkle manifest of a dataset: subroots of sources, one root, and a proof for every row.

A row's leaf is a SHA-256 over its fields.  In a source, leaves ascend by id;
every ``RUN`` consecutive nodes become the hash of their digests, level by
level, until one node remains, the subroot; subroots in order of source give
the root the same way.

Nested-struct rollup: a leaf's rank is written in digits of base ``RUN``.
Inside a block of ``RUN ** DIGITS`` leaves the digits are grouped away one after
the other, least first; each grouping nests the child structs in their parent,
and since the rows are already dealt by block, only the first one shuffles.
A block is one row of bounded size.  Block digests, ``RUN ** DIGITS`` times
fewer, are the nodes of the next pass.  On the way back a block meets its own
proof in a union grouped by block, and transform and explode open it digit by
digit, so proofs need no join.

A run of one is hashed like any other, but a node that is alone in its source
is left as it is: that is the first run with one node.

Edge cases: null fields are hashed as ``-``; a null id comes first and equal ids
follow the order of their leaves; repeated rows are leaves of their own; null
sources are one source, the first; an empty text differs from a null one; an
empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import number_in_groups
from tidemark.session import materialize

RUN = 16
DIGITS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Hex characters of a digest.
WIDTH = 64


def leaf_of(**instead: Column) -> Column:
    """The leaf of a row with ``FIELDS``; ``instead`` replaces fields."""
    def field(name: str) -> Column:
        x = instead.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return F.sha2(F.concat(*map(field, FIELDS)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and its ``proof`` (siblings left and right of it, from the leaf's level up) give."""
    return F.aggregate(proof, leaf, lambda digest, x: F.sha2(F.concat(x["left"], digest, x["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one string."""
    return F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), "")


def roll(nodes: DataFrame) -> DataFrame:
    """(grp, block, digest, hashed, kids): ``nodes`` (grp, rank, digest, keep) rolled up to one row a block.

    ``kids`` nests the digits, most significant outside; ``hashed`` tells whether
    a node is the hash of its kids or the only one of them.
    """
    digit = [F.shiftright("rank", 4 * k).bitwiseAND(F.lit(RUN - 1)).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    level = nodes.select("grp", F.shiftright("rank", 4 * DIGITS).alias("block"), *digit, "digest", "keep").repartition("grp", "block")
    kid = F.struct("d0", "digest", "keep")
    for k in range(DIGITS):
        above = [f"d{j}" for j in range(k + 1, DIGITS)]
        first = F.col("block") == 0
        for name in above:
            first &= F.col(name) == 0
        level = (level.groupBy("grp", "block", *above).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
                 .withColumn("hashed", ~first | (F.size("kids") > 1))
                 .withColumn("digest", F.when(F.col("hashed"), F.sha2(F.array_join("kids.digest", ""), 256)).otherwise(F.get("kids.digest", F.lit(0)))))
        kid = F.struct(*[f"d{k + 1}"] * (k + 1 < DIGITS), "digest", "hashed", "kids")
    return level.select("grp", "block", "digest", "hashed", "kids")


def rolled(nodes: DataFrame) -> list[DataFrame]:
    """The written tables of all passes, from the leaves up; the last has one row a group, whose digest is the group's."""
    passes: list[DataFrame] = []
    while True:
        passes.append(materialize(roll(nodes), "merkle-blocks"))
        if not passes[-1].agg(F.max("block")).first()[0]:
            return passes
        nodes = passes[-1].select("grp", F.col("block").alias("rank"), "digest", F.struct(F.lit(True)).alias("keep"))


def unrolled(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """(grp, digest, keep, path, top) of every node; ``above`` (grp, path, top) has what stands over each group.

    ``path`` holds the siblings at each level, from the root down; ``top`` is handed on.
    """
    above = above.select("grp", F.lit(0).cast("long").alias("block"), F.struct("path", "top").alias("over"))
    for blocks in reversed(passes):
        tree = F.struct("hashed", "kids")
        both = (blocks.select("grp", "block", tree.alias("tree"), F.lit(None).cast(above.schema["over"].dataType).alias("over"))
                .unionByName(above.select("grp", "block", F.lit(None).cast(blocks.select(tree.alias("t")).schema["t"].dataType).alias("tree"), "over")))
        rows = (both.groupBy("grp", "block").agg(F.first("tree", True).alias("tree"), F.first("over", True).alias("over"))
                .select("grp", F.col("block").alias("rank"), "over.path", "over.top", "tree.hashed", "tree.kids"))
        for k in reversed(range(DIGITS)):
            rows = rows.select("grp", "rank", "path", "top", "hashed", F.array_join("kids.digest", "").alias("run"), F.posexplode("kids").alias("i", "kid"))
            step = F.struct(F.substr("run", F.lit(1), WIDTH * F.col("i")).alias("left"), F.substr("run", WIDTH * F.col("i") + (WIDTH + 1)).alias("right"))
            rows = rows.select("grp", (F.col("rank") * RUN + F.col("i")).alias("rank"), F.when(F.col("hashed"), F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
                               "top", *(["kid.hashed", "kid.kids"] if k else ["kid.digest", "kid.keep"]))
        above = rows.select("grp", F.col("rank").alias("block"), F.struct("path", "top").alias("over"))
    return rows.select("grp", "digest", "keep", "path", "top")


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (doc_id, source, leaf, and any others) with subroot, root and proof (array<struct<left, right>>, from the leaf up)."""
    rest = [c for c in leaves.columns if c not in ("source", "leaf")]
    ranked = number_in_groups(materialize(leaves, "merkle-leaves"), ["source"], ["doc_id", "leaf"], "place")
    passes = rolled(ranked.select(F.col("source").alias("grp"), (F.col("place") - 1).alias("rank"), F.col("leaf").alias("digest"), F.struct(*rest).alias("keep")))
    subroots = passes[-1].select(F.col("grp").alias("source"), F.col("digest").alias("subroot"))
    order = number_in_groups(subroots, [], ["source"], "place")
    upper = rolled(order.select(F.lit(0).alias("grp"), (F.col("place") - 1).alias("rank"), F.col("subroot").alias("digest"), F.struct("source").alias("keep")))
    start = F.array().cast("array<struct<left:string,right:string>>")
    over = unrolled(upper, upper[-1].select("grp", start.alias("path"), F.col("digest").alias("top")))
    over = over.select(F.col("keep.source").alias("grp"), "path", F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"))
    return unrolled(passes, over).select(*[F.col(f"keep.{c}").alias(c) for c in rest], F.col("grp").alias("source"), F.col("digest").alias("leaf"), "top.subroot", "top.root", F.reverse("path").alias("proof"))
