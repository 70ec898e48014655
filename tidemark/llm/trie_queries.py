"""Registered query of the prefix trie, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize

from . import prefix_trie
from .common import table
from .manifest_queries import crc32_sql


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    whole = prefix_trie.rebuilt(lists, 5, F.crc32(F.col("conv_id").cast("string")) % 9)
    return prefix_trie.trie(prefix_trie.encoded(materialize(whole, "trie-rebuilt")))


ORACLES = {
    "op11_prefix_trie": f"""
        WITH t AS (SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations WHERE conv_id IS NOT NULL),
             l AS (SELECT conv_id, list(t ORDER BY turn NULLS FIRST, t.role, t.text) AS ts, ({crc32_sql("conv_id::VARCHAR")} % 9)::BIGINT AS h FROM t GROUP BY conv_id),
             r AS (SELECT l.conv_id, list_concat(coalesce(b.ts, [])[1:l.h], l.ts[l.h + 1:]) AS ts FROM l LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 5),
             m AS (SELECT conv_id, unnest(range(0, len(ts) + 1)) AS depth, ts FROM r),
             n AS (SELECT depth, ts[1:depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CASE WHEN len(ts) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
                   FROM m GROUP BY 1, 2),
             k AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
             x AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(n.p[n.depth].text)) END AS own FROM n LEFT JOIN k ON n.depth = k.depth AND n.p = k.p),
             a AS (SELECT unnest(range(0, depth + 1)) AS depth, p, own, n_children FROM x),
             s AS (SELECT depth, p[1:depth] AS p, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM a GROUP BY 1, 2)
        SELECT x.conv_id, x.depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved_tokens, x.ends_sha256
        FROM x JOIN s ON x.depth = s.depth AND x.p = s.p LEFT JOIN n u ON u.depth = x.depth - 1 AND u.p = x.p[1:x.depth - 1]""",
}
