"""Registered query of the Merkle manifest, and its DuckDB SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import merkle
from .common import table


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *merkle.FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select("doc_id", "source", merkle.leaf_of().alias("leaf"), F.when(tampered, merkle.leaf_of(text=lowered)).alias("claimed"))
    return (merkle.manifest(leaves)
            .select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                    merkle.fold(F.coalesce("claimed", "leaf"), F.col("proof")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def crc32_sql(digits: str) -> str:
    """DuckDB SQL: unsigned CRC-32 of an ASCII string."""
    bits = "list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::UBIGINT) ELSE y >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({digits}, ''), lambda c: ascii(c)::UBIGINT)), lambda a, b: {bits}), 4294967295::UBIGINT)"


def _tree_sql(prefix: str, levels: int) -> str:
    """CTEs {prefix}1.. over {prefix}0 (g, r, digest): the nodes and runs of each level; a group with one node is left as it is."""
    out = []
    for k in range(levels):
        out.append(f"{prefix}r{k} AS (SELECT g, r // 16 AS r, string_agg(digest, '' ORDER BY r) AS run, count(*) AS n FROM {prefix}{k} GROUP BY g, r // 16)")
        out.append(f"{prefix}{k + 1} AS (SELECT g, r, CASE WHEN n = 1 AND max(r) OVER (PARTITION BY g) = 0 THEN run ELSE sha256(run) END AS digest FROM {prefix}r{k})")
    return ",\n".join(out)


def _fold_sql(source: str, prefix: str, levels: int, name: str, start: str, others: str) -> str:
    """CTEs that fold ``start`` of the rows of ``source`` (g, r) up the tree, collecting siblings; the last is ``name``."""
    out, last = [], f"SELECT *, r AS node, {start} AS folded, {others} AS proof FROM {source}"
    for k in range(levels):
        out.append(f"{name}{k} AS ({last})")
        last = f"""SELECT f.* EXCLUDE (node, folded, proof), f.node // 16 AS node,
            CASE WHEN alone THEN folded ELSE sha256(left(run, 64 * (f.node % 16)) || folded || substr(run, 64 * (f.node % 16) + 65)) END AS folded,
            CASE WHEN alone THEN proof ELSE proof || left(run, 64 * (f.node % 16)) || substr(run, 64 * (f.node % 16) + 65) END AS proof
            FROM {name}{k} f JOIN (SELECT *, n = 1 AND max(r) OVER (PARTITION BY g) = 0 AS alone FROM {prefix}r{k}) x ON x.g IS NOT DISTINCT FROM f.g AND x.r = f.node // 16"""
    return ",\n".join([*out, f"{name} AS ({last})"])


_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Levels of the SQL's trees: 16 ** 6 documents a source, 16 ** 3 sources.
ORACLES = {
    "op13_merkle_manifest": f"""
        WITH l AS (SELECT doc_id, source AS g, {_leaf_sql("text")} AS leaf,
                          CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} END AS claimed FROM documents),
             s0 AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM l),
             {_tree_sql("s", 6)},
             u0 AS (SELECT 0 AS g, g AS source, digest, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS r FROM s6),
             {_tree_sql("u", 3)},
             {_fold_sql("s0", "s", 6, "f", "coalesce(claimed, leaf)", "''")},
             w AS (SELECT 0 AS g, u0.r AS r, f.doc_id, f.leaf, u0.digest AS subroot, f.folded AS begun, f.proof AS so_far FROM f JOIN u0 ON u0.source IS NOT DISTINCT FROM f.g),
             {_fold_sql("w", "u", 3, "v", "begun", "so_far")}
        SELECT doc_id, leaf, subroot, u3.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u3.digest AS verified FROM v, u3""",
}
