"""Jobs that carry a table from one run to the next.

State is immutable: each function takes the previous version and returns the next one, to be
written as a new version with :func:`fleetquarry.sources.sinks.write_version`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fleetquarry.functions.times import Moment, moment, parse_mixed
from fleetquarry.operators.joins import blank_key, blank_safe, is_collated
from fleetquarry.operators.latest import drop_older, newest_by_key, upsert

SHARE_KEYS = ("resource_id", "shared_folder_name")
EVENT_KEYS = ("resource_id", "index", "instance_id")
PERMISSION_KEYS = (
    "resource_id",
    "shared_folder_name",
    "time_added",
    "permission_type",
    "security_principal",
    "file_system_rights",
    "access_control_type",
)
RETENTION_DAYS = 180
STAMP = "dd.MM.yyyy HH:mm"


def reconcile(
    state: DataFrame,
    snapshot: DataFrame,
    as_of: Moment,
    keys: Sequence[str] = SHARE_KEYS,
    actor: str = "Script",
    lists: Sequence[str] = (),
) -> DataFrame:
    """Next approval state from the previous one and the current snapshot, in one join.

    Only in the snapshot: a New row. Only in the state: dropped. Different permissions: the
    row becomes Modified and remembers the previous text. Same, or not comparable: untouched.
    ``state``: keys, check_status, check_status_time, changed_by, old_permissions,
    new_permissions. ``snapshot``: keys, permissions. ``lists`` names further columns of the snapshot that stand for the same
    permissions (arrays of entries): the state carries them as ``old_...`` and ``new_...``, and texts that are equal by
    chance while a list differs are different.
    """
    # rows only in the state are the ones to drop, so the join keeps the snapshot's side
    return _reconciled(state, snapshot, as_of, keys, actor, lists, "left").drop("__same", "__gone")


def reconcile_changes(
    state: DataFrame,
    snapshot: DataFrame,
    as_of: Moment,
    keys: Sequence[str] = SHARE_KEYS,
    actor: str = "Script",
    lists: Sequence[str] = (),
) -> DataFrame:
    """What :func:`reconcile` changes, as rows with ``op`` insert, update or delete; untouched rows are not among them.

    To be applied to a state in hash buckets (``buckets.apply_changes``), whose side of the join is not exchanged.
    """
    both = _reconciled(state, snapshot, as_of, keys, actor, lists, "full")
    kind = F.when(F.col("__gone"), F.lit("delete")).when(F.col("check_status") == "New", F.lit("insert")).otherwise(F.lit("update"))
    changed = both.filter(F.col("__gone") | ~F.col("__same"))
    return changed.select(kind.alias("op"), *[c for c in changed.columns if c not in ("__same", "__gone")])


def _reconciled(
    state: DataFrame, snapshot: DataFrame, as_of: Moment, keys: Sequence[str], actor: str, lists: Sequence[str], how: str
) -> DataFrame:
    """Next state rows with ``__same`` (untouched) and ``__gone`` (only in the state)."""
    old = state.select(*[F.col(c).alias(f"s_{c}") for c in state.columns], F.lit(True).alias("known"))
    now = snapshot.select(*keys, "permissions", *lists).dropDuplicates([*keys, "permissions", *lists])
    now = now.withColumn("here", F.lit(True))
    both = now.join(old, [now[k] == old[f"s_{k}"] for k in keys], how)
    is_new, gone = F.col("known").isNull(), F.col("here").isNull()
    changed = F.coalesce(F.col("permissions") != F.col("s_new_permissions"), F.lit(False))
    for name in lists:
        changed = changed | F.coalesce(F.col(name) != F.col(f"s_new_{name}"), F.lit(False))
    touched = is_new | changed

    def pick(name: str, when_new, when_changed):
        return (
            F.when(is_new, when_new)
            .when(touched, when_changed)
            .otherwise(F.col(f"s_{name}"))
            .alias(name)
        )

    return both.select(
        *[F.coalesce(k, f"s_{k}").alias(k) for k in keys],
        pick("check_status", F.lit("New"), F.lit("Modified")),
        pick("check_status_time", moment(as_of), moment(as_of)),
        pick("changed_by", F.lit(actor), F.lit(actor)),
        pick("old_permissions", F.lit("None"), F.col("s_new_permissions")),
        pick("new_permissions", F.col("permissions"), F.col("permissions")),
        *[pick(f"old_{n}", F.lit(None), F.col(f"s_new_{n}")) for n in lists],
        *[pick(f"new_{n}", F.col(n), F.col(n)) for n in lists],
        (~touched).alias("__same"),
        gone.alias("__gone"),
    )


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to append: unseen in ``target`` and once per key within the batch.

    The target is scanned for the batch's keys and only what is found is compared, so its history
    is not shuffled while those keys fit a broadcast. NULL and '' are the same key.
    """
    # texts under a collation are matched by a plain text that stands for them; a number in front settles nearly every comparison
    hashed = any(is_collated(batch, k) for k in keys)
    names = [f"__b{i}" for i in range(len(keys) + hashed)]

    def blank(df: DataFrame, prefix: str) -> list[Column]:
        safe = [blank_key(df, k) for k in keys]
        return [c.alias(f"{prefix}{i}") for i, c in enumerate([F.xxhash64(*safe), *safe] if hashed else safe)]

    every = sorted(keys) == sorted(batch.columns) and len(keys) < 63 and not hashed
    once = _distinct_rows(batch, keys, names) if every else newest_by_key(batch.select("*", *blank(batch, "__b")), names, [])
    known = target.select(*blank(target, "__k"))
    wanted = once.select(*[F.col(n).alias(n.replace("__b", "__w")) for n in names])
    hits = known.join(wanted, [known[f"__k{i}"] == wanted[f"__w{i}"] for i in range(len(names))], "left_semi")
    return once.join(hits, [once[n] == hits[f"__k{i}"] for i, n in enumerate(names)], "left_anti").select(*batch.columns)


def _distinct_rows(batch: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``batch``, all of whose columns are keys, once per key, with its blank-safe keys under ``names``.

    Rows of one key differ in nothing but NULL and '' texts, so a number tells which of them they have: a hash
    aggregate of fixed width keeps the greatest, as the first of its columns that differ decides.
    """
    text = {k: isinstance(batch.schema[k].dataType, StringType) for k in keys}
    blank = [blank_safe(batch, k).alias(n) for k, n in zip(keys, names)]
    present = [F.when(F.col(k).isNotNull(), 1 << i).otherwise(0).cast("long") for i, k in enumerate(reversed(batch.columns)) if text[k]]
    marks = sum(present, F.lit(0).cast("long"))
    own = [k for k in keys if not text[k]]
    grouped = batch.select(*own, *blank, marks.alias("__marks")).groupBy(*names, *own).agg(F.max("__marks").alias("__marks"))
    bit = {k: 1 << i for i, k in enumerate(reversed(batch.columns))}
    shown = [
        F.when(F.col("__marks").bitwiseAND(F.lit(bit[k]).cast("long")) > 0, F.col(n)).alias(k) if text[k] else F.col(k)
        for k, n in zip(keys, names)
    ]
    return grouped.select(*shown, *names).select(*batch.columns, *names)


def merge_events(
    store: DataFrame,
    batch: DataFrame,
    as_of: Moment,
    keys: Sequence[str] = EVENT_KEYS,
    days: int = RETENTION_DAYS,
    order: str | None = None,
) -> DataFrame:
    """Next event store: old rows purged by event time first, then the batch upserted.

    ``order`` says which of the batch's repeats of a key was written last.
    """
    kept = drop_older(store, parse_mixed("time_generated"), as_of, days)
    return upsert(kept, batch, keys, order)


def merge_permissions(
    store: DataFrame,
    batch: DataFrame,
    as_of: Moment,
    keys: Sequence[str] = PERMISSION_KEYS,
    days: int = RETENTION_DAYS,
) -> DataFrame:
    """Next permission store. The scan time is part of the key, so scans accumulate."""
    kept = drop_older(store, parse_mixed("time_added"), as_of, days)
    return upsert(kept, batch, keys)


def stamped(rows: DataFrame, at: Moment, column: str = "time_added") -> DataFrame:
    """``rows`` of one inventory run with the time they are stored, in the writer's layout.

    For permissions the stamp is part of the key and tells the scan; an own ``column`` is replaced.
    """
    return rows.withColumn(column, F.date_format(moment(at), STAMP))
