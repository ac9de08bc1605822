"""Folding, applying and comparing changelogs.

Keys are primary keys: not NULL. Order inside a key comes from ``__seq``; a DataFrame has no order of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.envelope import (
    DELETE,
    INSERT,
    KIND,
    SEQ,
    UPDATE_AFTER,
    UPDATE_BEFORE,
    payload_columns,
    quoted,
    require_columns,
)
from millrace.session import written

_PLACE = "__place"
_COUNT = "__count"


def kind_order() -> Column:
    """Order of kinds that share a sequence number: a delete comes before the row that replaces it."""
    return (
        F.when(F.col(KIND) == UPDATE_BEFORE, 0).when(F.col(KIND) == DELETE, 1).when(F.col(KIND) == INSERT, 2).otherwise(3)
    )


def known_kinds(changes: DataFrame) -> DataFrame:
    """A row without a kind is an error, not a row to leave out."""
    message = F.lit(f"a change has no {KIND}")
    return changes.withColumn(KIND, F.when(F.col(KIND).isNull(), F.raise_error(message)).otherwise(F.col(KIND)))


def latest_changes(changes: DataFrame, *, keys: Sequence[str], order_by: str | Sequence[str] = SEQ) -> DataFrame:
    """The last change of each key, deletes included; UPDATE_BEFORE says nothing about a keyed table.

    Ranking with a limit of one row per key: Spark ranks before the shuffle as well, so each task sends at most one
    row per key and a key holding most of the changes costs no more than another.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    require_columns(changes, [*keys, *order, KIND], "latest_changes")
    newest_first = [F.col(quoted(name)).desc() for name in order]
    place = Window.partitionBy(*[F.col(quoted(key)) for key in keys]).orderBy(*newest_first, kind_order().desc())
    ranked = known_kinds(changes).where(F.col(KIND) != UPDATE_BEFORE).withColumn(_PLACE, F.row_number().over(place))
    return ranked.where(F.col(_PLACE) == 1).drop(_PLACE)


def fold_changelog(changes: DataFrame, *, keys: Sequence[str], order_by: str | Sequence[str] = SEQ) -> DataFrame:
    """The keyed table a changelog (initial load and changes) leads to."""
    last = latest_changes(changes, keys=keys, order_by=order_by)
    return last.where(F.col(KIND) != DELETE).select(*[F.col(quoted(name)) for name in payload_columns(changes)])


# Copies of one row that a single generator call may emit.
_COPIES_PER_CALL = 10_000


def fold_retractions(changes: DataFrame) -> DataFrame:
    """The unkeyed table (a multiset of rows) a retract changelog leads to: inserts and after-images add a row,
    before-images and deletes take one away.

    Signs are summed on the map side. A row that remains a great many times is spread over tasks before it is
    repeated.
    """
    columns = payload_columns(changes)
    sign = F.when(F.col(KIND).isin(INSERT, UPDATE_AFTER), F.lit(1)).otherwise(F.lit(-1))
    counted = known_kinds(changes).groupBy(*[F.col(quoted(name)) for name in columns]).agg(F.sum(sign).alias(_COUNT))
    short = F.raise_error(F.lit("a row is retracted more often than it was added"))
    counted = counted.withColumn(_COUNT, F.when(F.col(_COUNT) < 0, short).otherwise(F.col(_COUNT)))
    calls = F.ceil(F.col(_COUNT) / _COPIES_PER_CALL).cast("int")
    spread = (
        counted.where(F.col(_COUNT) > 0)
        .withColumn("__call", F.explode(F.sequence(F.lit(1), calls)))
        .withColumn(
            "__copies",
            F.least(F.lit(_COPIES_PER_CALL), F.col(_COUNT) - (F.col("__call") - 1) * _COPIES_PER_CALL).cast("int"),
        )
    )
    hot = spread.where(F.col(_COUNT) > _COPIES_PER_CALL).repartition(*[F.col(quoted(n)) for n in columns], F.col("__call"))
    cold = spread.where(F.col(_COUNT) <= _COPIES_PER_CALL)
    copies = cold.unionByName(hot).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return copies.select(*[F.col(quoted(name)) for name in columns])


def apply_changelog(
    target: DataFrame,
    changes: DataFrame,
    *,
    keys: Sequence[str],
    order_by: str | Sequence[str] = SEQ,
    enable_delete: bool = True,
) -> DataFrame:
    """The target after keyed upserts and deletes. Applying the same changes again changes nothing.

    Rows with a changed key are taken out of the target and the folded changes added. When the changed keys fit the
    broadcast threshold the (large) target is only filtered in place, never shuffled; otherwise both sides meet on
    the key. Without
    ``enable_delete`` a delete is ignored, and the last image before it counts.
    """
    require_columns(target, keys, "apply_changelog")
    if not enable_delete:
        changes = changes.where(F.col(KIND) != DELETE)
    columns = payload_columns(target)
    # Written once: the changes are read and shuffled a single time, and Spark knows the size of their keys.
    last = written(latest_changes(changes, keys=keys, order_by=order_by), "folded-changes")
    changed = last.select(*[F.col(quoted(key)).alias(f"__changed_{i}") for i, key in enumerate(keys)])
    same_key = F.lit(True)
    for i, key in enumerate(keys):
        same_key = same_key & (F.col(quoted(key)) == F.col(f"__changed_{i}"))
    untouched = target.select(*[F.col(quoted(n)) for n in columns]).join(changed, same_key, "left_anti")
    upserts = last.where(F.col(KIND) != DELETE).select(*[F.col(quoted(n)) for n in columns])
    return untouched.unionByName(upserts)


def changes_between(old: DataFrame, new: DataFrame, *, keys: Sequence[str], with_before: bool = True) -> DataFrame:
    """The changelog that turns snapshot ``old`` into ``new``: one full outer join on the key, unchanged rows drop
    out. ``with_before=False`` leaves the before-images away."""
    columns = payload_columns(new)
    require_columns(old, columns, "changes_between")

    def packed(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[F.col(quoted(c)) for c in columns]).alias(name)
        return df.select(*[F.col(quoted(key)).alias(f"__key_{i}") for i, key in enumerate(keys)], row)

    key_names = [f"__key_{i}" for i in range(len(keys))]
    both = packed(old, "__old").join(packed(new, "__new"), key_names, "full_outer")
    before = F.struct(F.lit(UPDATE_BEFORE).alias("kind"), F.col("__old").alias("row"))
    after = F.struct(F.lit(UPDATE_AFTER).alias("kind"), F.col("__new").alias("row"))
    images = (
        F.when(F.col("__old").isNull(), F.array(F.struct(F.lit(INSERT).alias("kind"), F.col("__new").alias("row"))))
        .when(F.col("__new").isNull(), F.array(F.struct(F.lit(DELETE).alias("kind"), F.col("__old").alias("row"))))
        .otherwise(F.array(before, after) if with_before else F.array(after))
    )
    changed = both.where(~F.col("__old").eqNullSafe(F.col("__new"))).select(F.inline(images))
    return changed.select("row.*", F.col("kind").alias(KIND))


def snapshot_then_changes(
    snapshot: DataFrame | None, changes: DataFrame, *, startup_mode: str = "initial", position: int | None = None
) -> DataFrame:
    """One changelog from a start mode: ``initial`` is the whole snapshot as inserts at sequence 0 and then every
    change; ``earliest`` only the changes; ``specific`` the changes after ``position``; ``latest`` those after the
    last position known now, which is the given ``position`` too."""
    if startup_mode == "initial":
        if snapshot is None:
            raise ValueError("startup mode initial needs a snapshot")
        loaded = snapshot.withColumns({KIND: F.lit(INSERT), SEQ: F.lit(0).cast("bigint")})
        after = changes if position is None else changes.where(F.col(SEQ) > position)
        return loaded.unionByName(after, allowMissingColumns=True)
    if startup_mode == "earliest":
        return changes
    if startup_mode in ("latest", "specific"):
        if position is None:
            raise ValueError(f"startup mode {startup_mode} needs a position")
        return changes.where(F.col(SEQ) > position)
    raise ValueError(f"unknown startup mode {startup_mode!r}")
