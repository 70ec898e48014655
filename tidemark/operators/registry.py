"""Model registry as two tables: ``model_versions`` and ``model_aliases``.

Versions are strings in storage and integers for ordering: the string
maximum of '9' and '10' is '9'.  Alias rows are upserted (newest writer
wins per (name, alias)).  Everything is vectorised over model names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CHAMPION_ALIAS

def _vnum():
    return F.col("version").cast("int")


def version_history(versions: DataFrame, name: str, descending: bool = True) -> DataFrame:
    rows = versions.filter(F.col("name") == name)
    order = F.desc(_vnum()) if descending else F.asc(_vnum())
    return rows.orderBy(order)


def latest_versions(versions: DataFrame) -> DataFrame:
    """Per model: the numerically highest version and its record."""
    packed = F.struct("version", "run_id", "creation_timestamp", "status")
    return versions.groupBy("name").agg(F.max_by(packed, _vnum()).alias("_v"), F.count(F.lit(1))
                                        .alias("n_versions")).select(
        "name", F.col("_v.version").alias("latest_version"), F.col("_v.run_id").alias("run_id"),
        F.col("_v.creation_timestamp").alias("creation_timestamp"), "n_versions")


def champion_from_latest(versions: DataFrame, at_col: str = "creation_timestamp") -> DataFrame:
    """Alias rows pointing ``champion`` at each model's newest version."""
    latest = latest_versions(versions)
    return latest.select("name", F.lit(CHAMPION_ALIAS).alias("alias"),
                         F.col("latest_version").alias("version"),
                         F.col(at_col).alias("set_time"))


def resolve_alias(aliases: DataFrame, versions: DataFrame, alias: str = CHAMPION_ALIAS) -> DataFrame:
    """``get_model_version_by_alias`` for every model at once."""
    a = aliases.filter(F.col("alias") == alias).select("name", "alias", "version")
    return a.join(versions, ["name", "version"], "inner")


def upsert_aliases(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Union, then the newest ``set_time`` per (name, alias) wins; ties go to
    the update side, then to the higher version."""
    tagged = (current.withColumn("_src", F.lit(0))
              .unionByName(updates.withColumn("_src", F.lit(1))))
    order = F.struct(F.col("set_time"), F.col("_src"), _vnum().alias("_v"))
    packed = F.struct("version", "set_time")
    return tagged.groupBy("name", "alias").agg(F.max_by(packed, order).alias("_a")).select(
        "name", "alias", F.col("_a.version").alias("version"), F.col("_a.set_time").alias("set_time"))


def promote(dev_versions: DataFrame, dev_aliases: DataFrame, prod_versions: DataFrame,
            prod_aliases: DataFrame, name_map, at) -> tuple[DataFrame, DataFrame]:
    """Copy each dev champion into the prod registry as the next version and
    point prod's champion alias at it.  Dev champions that share a prod name
    get consecutive versions, in run id order.

    ``name_map`` maps a dev name column to the prod name (a Column function).
    Returns (prod versions after, prod aliases after).
    """
    champ = resolve_alias(dev_aliases, dev_versions).select(
        name_map(F.col("name")).alias("name"), "run_id")
    # one row per dev model: as small as the registry
    champ = champ.withColumn("_position", F.row_number().over(Window.partitionBy("name").orderBy("run_id")))
    next_v = prod_versions.groupBy("name").agg(F.max(_vnum()).alias("_max"))
    new_rows = champ.join(next_v, "name", "left").select(
        "name", (F.coalesce(F.col("_max"), F.lit(0)) + F.col("_position")).cast("string").alias("version"),
        F.lit(at).cast("timestamp_ntz").alias("creation_timestamp"),
        F.lit("READY").alias("status"), "run_id")
    versions_after = prod_versions.select(*new_rows.columns).unionByName(new_rows)
    updates = new_rows.select("name", F.lit(CHAMPION_ALIAS).alias("alias"), "version",
                              F.col("creation_timestamp").alias("set_time"))
    return versions_after, upsert_aliases(prod_aliases, updates)
