"""Change images between snapshots, and upserts that apply them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.fingerprints import row_hashes
from riskloom.operators.skew import key_counts, lookup_join
from riskloom.schemas import LOADED_AT

INSERT = "INSERT"
DELETE = "DELETE"
# What a row of the new snapshot adds to the count of rows; old ones add 1.
_NEW = 1 << 32


def _at_most(copies: Column, message: str) -> Column:
    return F.when(copies <= 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def changed_keys(old: DataFrame, new: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """``key, _was, _now`` of rows that differ: in which snapshots the key is.

    Only the key and 128 bits of hash travel, XORed over both sides: they cancel where the
    compared columns are equal. A repeated key fails the query.
    """
    one, two = row_hashes(list(compare))
    # One number tells how many rows either side has.
    sides = old.select(key, one.alias("_one"), two.alias("_two"),
                       F.lit(1).cast("bigint").alias("_rows")).unionByName(
        new.select(key, one.alias("_one"), two.alias("_two"),
                   F.lit(_NEW).cast("bigint").alias("_rows")))
    met = sides.groupBy(key).agg(F.bit_xor("_one").alias("_one"), F.bit_xor("_two").alias("_two"),
                                 F.sum("_rows").alias("_rows"))
    was, now = F.col("_rows") % _NEW, F.floor(F.col("_rows") / _NEW)
    once = met.filter(_at_most(F.greatest(was, now), f"{key} is not unique in a snapshot"))
    differs = (F.col("_rows") != _NEW + 1) | (F.col("_one") != 0) | (F.col("_two") != 0)
    return once.filter(differs).select(key, (was == 1).alias("_was"), (now == 1).alias("_now"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str,
                  compare: Sequence[str] | None = None) -> DataFrame:
    """Row images that turn ``old`` into ``new``, with ``_action`` and ``_is_update``.

    An update is a DELETE of the old image and an INSERT of the new one, both
    marked ``_is_update``. ``compare`` limits which columns make a change (NULL
    equals NULL). ``key`` must be unique within each snapshot; a repeated key
    fails the query. Snapshots meet as keys and hashes, see :func:`changed_keys`;
    only for keys that changed are the images fetched. Images are equal when 128 bits
    of hash are.
    """
    columns = new.columns
    compare = [c for c in columns if c != key] if compare is None else list(compare)
    changed = changed_keys(old, new, key, compare).withColumnRenamed(key, "_key")
    updated = F.col("_was") & F.col("_now")

    def images(side: DataFrame, there: str, action: str) -> DataFrame:
        met = side.join(changed.filter(there), F.col(key).eqNullSafe(F.col("_key")))
        return met.select(F.lit(action).alias("_action"), updated.alias("_is_update"), *columns)

    return images(old, "_was", DELETE).unionByName(images(new, "_now", INSERT))


def inserted(changes: DataFrame) -> DataFrame:
    """Images of new rows and of new versions, without the change columns."""
    return changes.filter(F.col("_action") == INSERT).drop("_action", "_is_update")


def apply_changes(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Replay :func:`snapshot_diff` onto the snapshot it started from."""
    touched = changes.select(F.col(key).alias("_touched")).distinct()
    kept = old.join(touched, F.col(key).eqNullSafe(F.col("_touched")), "left_anti")
    return kept.unionByName(inserted(changes))


def latest(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Last version per key, for deliveries holding several versions of a row."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order_by))
    return df.groupBy(key).agg(newest.alias("row")).select("row.*")


def upsert(target: DataFrame, source: DataFrame, key: str, update: Sequence[str],
           loaded_at: Column | None = None, null_safe: bool = False,
           hot_rows: int | None = None) -> DataFrame:
    """Target after merging ``source``: changed rows updated, unknown keys inserted.

    A target row changes when one of the ``update`` columns differs; it then takes
    those columns from the source and a new load time. A comparison with NULL on
    either side is no change, unless ``null_safe``. Nothing is deleted. ``source``
    must have one row per key; a repeated key fails the query. A row without a key
    matches nothing and is always inserted. The target may repeat keys, even heavily.
    """
    stamp = F.localtimestamp() if loaded_at is None else loaded_at
    columns = target.columns
    fields = [c for c in source.columns if c not in (key, LOADED_AT)]

    keyless = source.filter(F.col(key).isNull()).select(key, *fields)
    single = source.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.max(c).alias(c) for c in fields]
    ).filter(_at_most(F.col("_copies"), f"{key} is not unique in the source"))
    new_values = single.select(
        key, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in update]
    )

    counts = key_counts(target, [key])
    matched = lookup_join(target, new_values, key, "left", hot_rows, counts)
    differs = [
        ~F.col(c).eqNullSafe(F.col(f"_new_{c}")) if null_safe else F.col(c) != F.col(f"_new_{c}")
        for c in update
    ]
    changed = F.col("_matched") & reduce(lambda a, b: a | b, differs)
    taken = {c: F.col(f"_new_{c}") for c in update}
    if LOADED_AT in columns:
        taken[LOADED_AT] = stamp
    kept = matched.select(*[
        F.when(changed, taken[c]).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
        for c in columns
    ])

    fresh = single.join(counts.select(key), key, "left_anti").select(key, *fields).union(keyless)
    added = fresh.select(*[
        stamp.alias(c) if c == LOADED_AT
        else F.col(c) if c in fresh.columns
        else F.lit(None).cast(target.schema[c].dataType).alias(c)
        for c in columns
    ])
    return kept.unionByName(added)
