"""Comparing with the stored rows and merging into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.operators.ranking import first_per_group


FEW_KEYS = 4096
LONGEST_KEY = 2048


def having(stored: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``stored`` that may have one of the ``keys``, for any comparison by that key.

    Up to ``FEW_KEYS`` distinct keys of at most ``LONGEST_KEY`` characters become a filter on the scan, which skips the row groups whose Bloom
    filters or statistics hold none of them (an increment without keys reads nothing). With more keys it is the whole table; a join gives the same either way.
    Evaluates ``keys``, which should be narrow or kept.
    """
    short = F.when(F.length(key) <= LONGEST_KEY, F.col(key))
    few = [r[0] for r in keys.filter(F.col(key).isNotNull()).select(key).distinct().select(short).limit(FEW_KEYS + 1).collect()]
    if len(few) > FEW_KEYS or None in few:
        return stored
    return stored.filter(F.col(key).isin(few)) if few else stored.limit(0)


def known_keys(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The stored keys which occur in ``incoming``.

    ``stored`` is the streamed side: an increment below the broadcast threshold moves no stored row,
    and of both tables only the key column is read. The incoming keys are made distinct first, map-side,
    so a key with most of the increment is one row per task afterwards.
    """
    return stored.select(key).join(incoming.select(key).distinct(), key, "left_semi")


def new_items(items: DataFrame, stored: DataFrame, key: str = "url") -> DataFrame:
    """Items whose key is not stored. Repeats inside ``items`` stay, null keys count as new.

    Of the stored table only the key column is read; whether it is broadcast or shuffled is left to adaptive execution,
    which also splits a hot key.
    """
    return items.join(stored.select(key), key, "left_anti").select(items.columns)


def existing_urls(urls: DataFrame, stored: DataFrame) -> DataFrame:
    """The distinct URLs of ``urls`` which are stored."""
    return known_keys(urls, stored, "url").distinct()


def url_exists(items: DataFrame, stored: DataFrame, flag: str = "is_stored") -> DataFrame:
    """``items`` with a flag telling whether a stored row has the same URL."""
    known = existing_urls(items, stored).withColumn("__known", F.lit(True))
    return (
        items.join(known, "url", "left")
        .withColumn(flag, F.coalesce("__known", F.lit(False)))
        .select(*items.columns, flag)
    )


def insert_if_absent(
    incoming: DataFrame, stored: DataFrame, key: str = "dedup_key", order: list[str | Column] | None = None
) -> DataFrame:
    """The rows to append: one per key which is not stored yet. Stored rows stay untouched.

    Of several incoming rows with one key the first in ``order`` stays, by default the first by the hash of its values, so
    the choice never depends on how the rows are dealt out.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order or []]
    order += [F.xxhash64(*[F.col(c).cast("string") for c in sorted(incoming.columns)])]
    return first_per_group(new_items(incoming, stored, key), [key], order, 1)


def last_per_key(incoming: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The last row per key in ascending ``order``."""
    latest = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    return first_per_group(incoming, [key], latest, 1)


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    key: str = "dedup_key",
    order: list[str | Column] | None = None,
    defaults: dict[str, Column] | None = None,
    update: list[str] | tuple[str, ...] | None = None,
) -> DataFrame:
    """The table after inserting or updating by ``key``.

    Only columns ``incoming`` has are overwritten, nulls included; the others keep their stored value.
    ``update`` names the columns that a stored row may get; new rows get all. New rows take ``defaults`` (else null) for what
    they lack. With several incoming rows per key the last in ``order`` counts (by default in order of the hash of their values).

    A left join for the updates plus the unmatched incoming rows, rather than a full outer join: an
    increment below the broadcast threshold then moves no stored row at all.
    """
    defaults = defaults or {}
    order = order or [F.xxhash64(*[F.col(c).cast("string") for c in sorted(incoming.columns)])]
    incoming = last_per_key(incoming, key, order)
    incoming = incoming.select([c for c in incoming.columns if c in stored.columns])
    types = {f.name: f.dataType for f in stored.schema.fields}
    given = [c for c in incoming.columns if c != key and (update is None or c in update)]
    change = incoming.select(
        F.col(key).alias("__key"), F.struct(F.lit(True).alias("__hit"), *given).alias("__new")
    )
    updated = stored.join(change, stored[key] == change["__key"], "left").select(
        *[
            (
                F.when(F.col("__new").isNotNull(), F.col("__new")[c].cast(types[c]))
                .otherwise(stored[c])
                .alias(c)
                if c in given
                else stored[c]
            )
            for c in stored.columns
        ]
    )
    fresh = incoming.join(known_keys(incoming, stored, key), key, "left_anti")
    inserted = fresh.select(
        *[
            (F.col(c) if c in incoming.columns else defaults.get(c, F.lit(None))).cast(types[c]).alias(c)
            for c in stored.columns
        ]
    )
    return updated.unionByName(inserted)


def upsert_items(stored: DataFrame, incoming: DataFrame, order: list | None = None, update=None) -> DataFrame:
    """``upsert`` of items by ``dedup_key`` with the table's column defaults."""
    return upsert(stored, incoming, "dedup_key", order, S.item_defaults(), update)
