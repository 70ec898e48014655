"""Deterministic per-row randomness.

``rand(seed)`` depends on how rows are spread over partitions, so a retried
or re-planned job would draw different numbers.  Here a row's draw is a
function of (seed, salt, key) only: the first 32 bits of an MD5 digest,
scaled to [0, 1).  The same expression is plain SQL in other engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(1 << 32)


def hash_uniform(seed: int, key: str | Column, salt: str = "") -> Column:
    """Uniform draw in [0, 1) from md5(seed|salt|key)."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}|{salt}|"), k.cast("string"))
    hi32 = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return hi32 / F.lit(_SCALE)


def digest(seed: int, key: str | Column, salt: str = "") -> Column:
    """md5(seed|salt|key) as hex text; project it once and slice it with
    :func:`digest_uniforms` (Spark keeps a projected expensive expression
    instead of inlining it into every consumer)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|{salt}|"), k.cast("string")))


def digest_uniforms(hex_digest: str | Column) -> list[Column]:
    """Four independent draws in [0, 1): the four 32-bit slices of a digest."""
    d = F.col(hex_digest) if isinstance(hex_digest, str) else hex_digest
    return [F.conv(F.substring(d, 1 + 8 * i, 8), 16, 10).cast("bigint") / F.lit(_SCALE)
            for i in range(4)]


def hash_uniforms(seed: int, key: str | Column, salt: str = "") -> list[Column]:
    """Four independent draws in [0, 1) from one MD5: its four 32-bit slices."""
    return digest_uniforms(digest(seed, key, salt))


def sql_hash_uniforms(seed: int, key_sql: str, salt: str = "") -> list[str]:
    text = f"concat('{seed}|{salt}|', CAST({key_sql} AS VARCHAR))"
    return [f"(CAST(('0x' || substr(md5({text}), {1 + 8 * i}, 8)) AS BIGINT) / {_SCALE})"
            for i in range(4)]


def uniform_real(seed: int, key: str | Column, low: float, high: float, salt: str) -> Column:
    return F.lit(low) + F.lit(high - low) * hash_uniform(seed, key, salt)


def uniform_int(seed: int, key: str | Column, low: int, high: int, salt: str) -> Column:
    """Integer in [low, high)."""
    return (F.lit(low) + F.floor(F.lit(high - low) * hash_uniform(seed, key, salt))).cast("int")


def sql_hash_uniform(seed: int, key_sql: str, salt: str = "") -> str:
    """The same draw as a DuckDB SQL expression (used by the oracles)."""
    text = f"concat('{seed}|{salt}|', CAST({key_sql} AS VARCHAR))"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / {_SCALE})"
