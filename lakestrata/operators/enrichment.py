"""Filling one table from another, and merging changes into a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize
from lakestrata.operators.dedupe import keep_latest


def left_fill(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fills: Mapping[str, Sequence[str]],
    carry: Sequence[str] = (),
    *,
    right_is_unique: bool = False,
) -> DataFrame:
    """Left join on ``key``; each filled column takes its first non-NULL source.

    ``fills`` maps an output column to sources in order of precedence, written
    ``"left.x"`` or ``"right.y"``. Other columns of ``left`` pass through and
    ``carry`` names the columns added from ``right``. Every left row comes out
    exactly once, also those with a NULL key.

    A right side not known to be unique is reduced to one row per key and
    written first. Both join inputs are then plain scans: Catalyst broadcasts
    the right one when its measured size allows, and otherwise AQE may cut the
    left rows of a hot (or NULL) key into several tasks.
    """
    if not right_is_unique:
        right = materialize(keep_latest(right.where(F.col(key).isNotNull()), [key]), "fill")
    kept = [
        F.coalesce(*[F.col(source) for source in fills[c]]).alias(c)
        if c in fills
        else F.col(f"left.{c}")
        for c in left.columns
    ]
    added = [F.col(f"right.{c}") for c in carry]
    matched = F.col(f"left.{key}") == F.col(f"right.{key}")
    return left.alias("left").join(right.alias("right"), matched, "left").select(*kept, *added)


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    newest: Sequence = (),
    *,
    keep_when_null: bool = True,
    many_changes: bool = False,
) -> DataFrame:
    """Target rows updated from ``changes``, plus the changes with new keys.

    With several changes per key the newest counts; changes with a NULL key are
    left out, as they can match nothing. ``keep_when_null`` keeps a target value
    where the change has NULL, else the change replaces the whole row.

    The target is the big side. It is joined to the reduced changes from the
    left, so a small set of changes is broadcast and the target is not
    shuffled; only matched keys, at most one per change, decide what is new.
    This reads the target twice. ``many_changes`` says that the changes are too many to
    broadcast: one full join then reads and shuffles both sides once.
    """
    keys = list(keys)
    latest = keep_latest(changes.dropna(subset=keys), keys, newest)
    changes = materialize(latest.select(*target.columns), "changes")

    flagged = changes.withColumn("_changed", F.lit(True))
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]

    def merged(name: str):
        if name in keys:
            return F.coalesce(f"old.{name}", f"new.{name}").alias(name)
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        if keep_when_null:
            return F.coalesce(new, old).alias(name)
        return F.when(F.col("new._changed"), new).otherwise(old).alias(name)

    updated = (
        target.alias("old")
        .join(flagged.alias("new"), same_key, "full" if many_changes else "left")
        .select(*[merged(c) for c in target.columns])
    )
    if many_changes:
        return updated
    matched = target.select(*keys).join(changes.select(*keys), keys, "left_semi")
    return updated.unionByName(changes.join(matched, keys, "left_anti"))
