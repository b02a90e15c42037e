"""Roles and role preferences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.operators.stored import insert_if_absent, last_per_key

def seed_roles(spark: SparkSession, stored: DataFrame | None = None) -> DataFrame:
    """The built-in roles not stored yet, ready to append."""
    roles = spark.createDataFrame(S.SEED_ROLES, "role_name string, description string").select(
        F.uuid().alias("role_id"), "role_name", "description", F.current_timestamp().alias("created_at")
    )
    return roles if stored is None else insert_if_absent(roles, stored, "role_name")


def role_map(roles: DataFrame) -> DataFrame:
    """``(role_name, role_id)``."""
    return roles.select("role_name", "role_id")


def role_id_of(roles: DataFrame, role_name: str) -> Column:
    """The role's id as a scalar subquery, null for an unknown role."""
    return roles.filter(F.col("role_name") == role_name).agg(F.min("role_id")).scalar()


def role_filter(
    items: DataFrame, roles: DataFrame, role_name: str | None, strict: bool = False
) -> DataFrame:
    """Items open to everybody (no target roles) or naming the role.

    An unknown role filters nothing; with ``strict`` it sees the open items only.
    """
    if not role_name:
        return items
    role_id = role_id_of(roles, role_name)
    is_open = F.coalesce(F.size("target_roles"), F.lit(0)) <= 0
    allowed = is_open | F.coalesce(F.array_contains("target_roles", role_id), F.lit(False))
    if not strict:
        allowed = allowed | role_id.isNull()
    return items.filter(allowed)


def roles_to_ids(items: DataFrame, roles: DataFrame, names: str = "role_names", out: str = "target_roles") -> DataFrame:
    """Sorted distinct ids of the role names in ``names``; unknown names are dropped, a name has one id (the smallest).

    The ids are found once per distinct list of names and joined back by that list, so items need no key and each keeps
    its row. Adaptive execution decides what is broadcast.
    """
    ids = roles.filter(F.col("role_name").isNotNull()).groupBy("role_name").agg(F.min("role_id").alias("role_id"))
    lists = items.select(F.col(names).alias("__names")).filter(F.size("__names") > 0).distinct()
    found = (
        lists.select("__names", F.explode("__names").alias("role_name")).join(ids, "role_name")
        .groupBy("__names").agg(F.array_sort(F.collect_set("role_id")).alias("__ids"))
    )
    joined = items.drop(out).join(found, F.col(names) == F.col("__names"), "left")
    return joined.withColumn(out, F.coalesce("__ids", F.array().cast("array<string>"))).drop("__names", "__ids")


def preferences_get(preferences: DataFrame, role_name: str) -> DataFrame:
    """The newest preference row of a role, or no row."""
    newest = [F.desc_nulls_last("updated_at"), F.col("preferences").cast("string")]
    return preferences.filter(F.col("role_name") == role_name).orderBy(*newest).limit(1)


def preferences_upsert(
    stored: DataFrame, incoming: DataFrame, stamped_at: Column | None = None, order: list | None = None
) -> DataFrame:
    """Preferences after writing ``incoming (role_name, preferences)``.

    Keys a row brings along overwrite, the others stay; rows written are stamped. ``incoming`` has one
    row per role unless ``order`` says which one is last.
    """
    if order:
        incoming = last_per_key(incoming, "role_name", order)
    now = F.current_timestamp() if stamped_at is None else stamped_at
    change = incoming.select("role_name", F.col("preferences").alias("__new"), F.lit(True).alias("__hit"))
    joined = stored.join(change, "role_name", "full_outer")
    nothing = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("preferences", nothing), F.coalesce("__new", nothing)
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return joined.select(
        "role_name",
        F.when(F.col("__hit"), F.map_concat(kept, new)).otherwise(F.col("preferences")).alias("preferences"),
        F.when(F.col("__hit"), now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
