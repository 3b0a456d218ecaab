"""Type-2 history: keep every version of every row of a changing source.

A history table is the source's columns plus five meta columns.  ``first_build`` starts one, ``apply`` returns its
content after another look at the source.

Plan of ``apply``.  Closed versions pass through untouched.  Current versions and source rows, one per key on either
side, meet in a single full outer join, so each is shuffled once; null keys never match and bypass the join, so they
cannot pile up in one task.  Versions whose surrogate the history has already are not added again, which makes a repeated
run change nothing: against the current version that is seen in the join; closed versions are asked first, for the
source rows whose surrogate they hold, within the range of the source's change times.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.dates import as_time, as_utc
from tidemark.functions.types import text_of
from tidemark.operators.keys import any_of, error_if_any, is_true, key_match, no_null, normalise_key, repeated_keys, resolve

HARD_DELETES = ("ignore", "invalidate", "new_record")


@dataclass(frozen=True)
class MetaColumns:
    """Names of the meta columns."""

    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    scd_id: str = "scd_id"
    updated_at: str = "scd_updated_at"
    is_deleted: str = "is_deleted"

    def names(self, with_deleted: bool) -> list[str]:
        base = [self.scd_id, self.updated_at, self.valid_from, self.valid_to]
        return base + [self.is_deleted] if with_deleted else base


@dataclass(frozen=True)
class Strategy:
    """When a row counts as changed.

    ``updated_at``: the source column with a row's change time, or None to use the run's clock.
    ``changed``: given the source and the history, a condition over ``cur.x`` (history) and ``src.x`` (source).
    ``checked``: the columns that tell whether a row of a change stream differs from the one before; None: it always does.
    """

    updated_at: str | None
    changed: Callable[[DataFrame, DataFrame, "Snapshot"], Column]
    checked: str | Sequence[str] | None = None


def timestamp_strategy(updated_at: str) -> Strategy:
    """Changed iff the source's change time is strictly later than the current version's start."""

    def changed(source: DataFrame, history: DataFrame, cfg: "Snapshot") -> Column:
        return F.col(f"cur.`{cfg.meta.valid_from}`") < F.col(f"src.`{resolve(source, updated_at)}`")

    return Strategy(updated_at, changed)


def check_strategy(columns: str | Sequence[str], updated_at: str | None = None) -> Strategy:
    """Changed iff any checked column differs, null counting as a value; 'all' checks every source column.

    A checked column the history does not have yet re-versions every row.
    """
    if columns != "all" and (isinstance(columns, str) or not columns):
        raise ValueError(f"check columns must be 'all' or a list of names, not {columns!r}")

    def changed(source: DataFrame, history: DataFrame, cfg: "Snapshot") -> Column:
        names = source.columns if columns == "all" else [resolve(source, c) for c in columns]
        known = {c.lower() for c in history.columns}
        if any(c.lower() not in known for c in names):
            return F.lit(True)
        return any_of([~F.col(f"cur.`{c}`").eqNullSafe(F.col(f"src.`{c}`")) for c in names])

    return Strategy(updated_at, changed, columns)


@dataclass(frozen=True)
class Snapshot:
    """Settings of one history table.

    ``current_value`` marks open versions instead of null (null still counts as open).
    ``null_safe_key`` lets null parts of a composite key match each other.
    ``hard_deletes``: what happens to keys gone from the source: 'ignore', 'invalidate' (close the version), or
    'new_record' (close it and add a version saying the row is deleted).
    """

    key: str | Sequence[str]
    strategy: Strategy
    hard_deletes: str = "ignore"
    current_value: dt.datetime | None = None
    meta: MetaColumns = field(default_factory=MetaColumns)
    null_safe_key: bool = False

    def __post_init__(self) -> None:
        if self.hard_deletes not in HARD_DELETES:
            raise ValueError(f"hard_deletes must be one of {HARD_DELETES}, not {self.hard_deletes!r}")
        if not normalise_key(self.key):
            raise ValueError("a history needs a unique key")

    @property
    def keeps_deleted(self) -> bool:
        return self.hard_deletes == "new_record"


def hard_deletes_from(hard_deletes: str | None = None, invalidate_hard_deletes: bool | None = None) -> str:
    """The deletion behaviour from the current setting or the older yes/no one; both together are an error."""
    if hard_deletes is not None and invalidate_hard_deletes is not None:
        raise ValueError("give hard_deletes or invalidate_hard_deletes, not both")
    return hard_deletes or ("invalidate" if invalidate_hard_deletes else "ignore")


def surrogate(parts: Sequence[tuple[Column, T.DataType]]) -> Column:
    """MD5 over the parts' texts joined by '|', null counting as an empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(text_of(c, t), F.lit("")) for c, t in parts]))


def _current_value(cfg: Snapshot) -> Column:
    return as_time(cfg.current_value)


def is_open(cfg: Snapshot) -> Column:
    """Condition of an open (current) version."""
    open_end = F.col(f"`{cfg.meta.valid_to}`").isNull()
    if cfg.current_value is None:
        return open_end
    return open_end | (F.col(f"`{cfg.meta.valid_to}`") == _current_value(cfg))


def _with_meta(source: DataFrame, cfg: Snapshot, now: dt.datetime) -> DataFrame:
    """The source as versions that start at their change time."""
    meta = cfg.meta
    clash = [c for c in source.columns if c in meta.names(cfg.keeps_deleted)]
    if clash:
        raise ValueError(f"source columns {clash} clash with the meta columns; rename the meta columns")
    changed_at = as_time(now)
    if cfg.strategy.updated_at is not None:
        name = resolve(source, cfg.strategy.updated_at)
        changed_at = as_utc(F.col(f"`{name}`"), source.schema[name].dataType)
    key = normalise_key(cfg.key, source)
    parts = [(F.col(f"`{k}`"), source.schema[k].dataType) for k in key]
    columns = {
        meta.scd_id: surrogate([*parts, (changed_at, T.TimestampNTZType())]),
        meta.updated_at: changed_at,
        meta.valid_from: changed_at,
        meta.valid_to: _current_value(cfg),
    }
    if cfg.keeps_deleted:
        columns[meta.is_deleted] = F.lit("False")
    return source.withColumns(columns)


def first_build(source: DataFrame, cfg: Snapshot, now: dt.datetime) -> DataFrame:
    """One open version per source row."""
    return _with_meta(source, cfg, now)


def validate_history(history: DataFrame, cfg: Snapshot) -> None:
    """The history carries every meta column the settings need."""
    missing = [c for c in cfg.meta.names(cfg.keeps_deleted) if c not in history.columns]
    if missing:
        raise ValueError(f"the history lacks the meta columns {missing}")


def apply(history: DataFrame, source: DataFrame, cfg: Snapshot, now: dt.datetime) -> DataFrame:
    """The whole history after another look at the source (see ``advance``)."""
    moved = advance(history, source, cfg, now)
    return history.filter(~is_open(cfg)).unionByName(moved, allowMissingColumns=True).select(moved.columns)


#: What becomes of a current version, or of a source row.
KEEP, CLOSE, INSERT, MARK_DELETED = 0, 1, 2, 3

def advance(
    history: DataFrame,
    source: DataFrame,
    cfg: Snapshot,
    now: dt.datetime,
    closed: DataFrame | None = None,
) -> DataFrame:
    """What the versions open so far become, plus the new ones; versions closed before are left out.

    New keys and changed rows get an open version; the version they replace is closed at the change time.  Source
    columns the history lacks are added (null for old versions); columns gone from the source stay, null for new
    versions.  Versions whose surrogate is already known are not added again.  A source that repeats a key is an
    error at run time.

    When ``history`` holds only the open versions, ``closed`` gives the others.
    """
    validate_history(history, cfg)
    meta = cfg.meta
    key = normalise_key(cfg.key, source, history)
    versions = _with_meta(source, cfg, now)
    added = [f for f in source.schema.fields if f.name not in history.columns]
    full = history.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}) if added else history
    end = as_time(now)

    changed = is_true(cfg.strategy.changed(source, history, cfg))
    was_deleted = F.lit(False)
    if cfg.keeps_deleted:
        was_deleted = is_true(F.col(f"cur.`{meta.is_deleted}`") == "True")
        changed = changed | was_deleted
    in_cur, in_src = F.col("cur._here").isNotNull(), F.col("src._there").isNotNull()

    def todo(*actions: int) -> Column:
        return F.array(*[F.lit(a) for a in actions])

    gone = todo(KEEP)
    if cfg.hard_deletes == "invalidate":
        gone = todo(CLOSE)
    elif cfg.keeps_deleted:
        gone = F.when(was_deleted, todo(KEEP)).otherwise(todo(CLOSE, MARK_DELETED))
    both = F.when(changed, todo(CLOSE, INSERT)).otherwise(todo(KEEP))
    actions = F.when(in_cur & in_src, both).when(in_cur, gone).otherwise(todo(INSERT))

    action = F.col("_action")
    marker = surrogate([(F.col(f"cur.`{meta.scd_id}`"), T.StringType()), (end, T.TimestampNTZType())])
    special = {
        meta.valid_to: [(CLOSE, F.when(in_src, F.col(f"src.`{meta.updated_at}`")).otherwise(end))],
        meta.valid_from: [(MARK_DELETED, end)],
        meta.updated_at: [(MARK_DELETED, end)],
        meta.scd_id: [(MARK_DELETED, marker)],
    }
    if cfg.keeps_deleted:
        special[meta.is_deleted] = [(MARK_DELETED, F.lit("True"))]

    provided = set(versions.columns)

    def value(name: str) -> Column:
        kind = full.schema[name].dataType
        new = F.col(f"src.`{name}`") if name in provided else F.lit(None)
        chosen = F.when(action == INSERT, new.cast(kind))
        for when, other in special.get(name, []):
            chosen = chosen.when(action == when, other.cast(kind))
        return chosen.otherwise(F.col(f"cur.`{name}`")).alias(name)

    # A version is not added if the history has its surrogate.
    same_id = F.col(f"cur.`{meta.scd_id}`")
    again = (action == INSERT) & (is_true(F.col(f"src.`{meta.scd_id}`") == same_id) | F.col("src._known"))

    def outcomes(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("_action", F.explode(actions)).filter(~again).select(*[value(c) for c in full.columns])

    current = full.filter(is_open(cfg)).withColumn("_here", F.lit(True))
    null_safe = cfg.null_safe_key and len(key) > 1
    complete = F.lit(True) if null_safe else is_true(no_null(key))
    others = (history.filter(~is_open(cfg)) if closed is None else closed).select(meta.scd_id, meta.updated_at)
    unmatched = current.filter(~complete).select(meta.scd_id, meta.updated_at)  # null keys don't meet in the join
    present = _marked(versions, others.unionByName(unmatched), cfg, now).withColumn("_there", F.lit(True))
    same_key = key_match("cur", "src", key, null_safe)
    met = current.filter(complete).alias("cur").join(present.filter(complete).alias("src"), same_key, "full")

    # Null keys match nothing: their current versions have lost their source, their source rows are new.  The filters
    # reach the scans, where statistics skip files without null keys.
    no_source = present.limit(0).alias("src")
    no_history = current.limit(0).alias("cur")
    lost = current.filter(~complete).alias("cur").join(no_source, F.lit(False), "left")
    fresh = present.filter(~complete).alias("src").join(no_history, F.lit(False), "left")

    result = outcomes(met).unionByName(outcomes(lost)).unionByName(outcomes(fresh))
    repeated = repeated_keys(source.filter(complete), key)
    return result.unionByName(error_if_any(repeated, f"the source repeats a value of the key {key}", result.schema))


def _marked(versions: DataFrame, others: DataFrame, cfg: Snapshot, now: dt.datetime) -> DataFrame:
    """``versions`` with ``_known``: whether one of the ``others`` has the surrogate already.

    Equal surrogates have equal change times, so only versions within the range of the source's change times are
    looked at: the bounds are literals, which skip files by their statistics.  With the run's clock as change time,
    that is no file in nearly every run, and nothing is joined.
    """
    meta = cfg.meta
    at, scd_id = F.col(f"`{meta.updated_at}`"), F.col(f"`{meta.scd_id}`")
    low = high = now
    if cfg.strategy.updated_at is not None:
        low, high = versions.agg(F.min(at), F.max(at)).first()
    if low is None:
        return versions.withColumn("_known", F.lit(False))
    ids = others.filter((at >= as_time(low)) & (at <= as_time(high))).select(scd_id.alias("_id"))
    if ids.isEmpty():
        return versions.withColumn("_known", F.lit(False))
    ids = ids.join(versions.select(scd_id.alias("_id")), "_id", "left_semi").distinct()
    return versions.join(ids, scd_id == F.col("_id"), "left").withColumn("_known", F.col("_id").isNotNull()).drop("_id")


def advance_by_changes(
    current: DataFrame, changes: DataFrame, cfg: Snapshot, now: dt.datetime, deleted: str | None = None
) -> DataFrame:
    """What the open versions become after a set of changes, and the versions in between, open or closed.

    ``changes`` may hold several rows of a key; every one that differs from the row before it becomes a version, valid
    until the next.  The result does not depend on how a stream of changes was cut, as long as a key's changes arrive in
    order; changes that are not later than the current version are left out.  Rows of one key and one change time are
    one change: that with the greatest row hash.  Without a change time every key has one change, at ``now``.  Rows with
    a null key have no neighbours: they are open versions, known by their surrogate.

    ``deleted`` names a boolean column of ``changes``, true for rows that say that their key is gone; it does not become a
    column of the history, and null counts as false.  Such a row closes the key's version at its change time.  With
    'new_record' the version that says so starts there, with the values of the version before and a surrogate made from
    that one's; with 'ignore' the row is left out.  It changes nothing where the key has no version or is deleted already,
    where its key or change time is null.  A row after it is a new version even if its values are those from before.
    """
    meta = cfg.meta
    fields = [f for f in changes.schema.fields if f.name != deleted]
    key = normalise_key(cfg.key, changes, current)
    added = [f for f in fields if f.name not in current.columns]
    full = current.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}) if added else current
    columns = [F.col(f"`{c}`") for c in full.columns]
    gone = F.lit(False) if deleted is None else is_true(F.col(f"`{deleted}`"))
    versions = _with_meta(changes.select(*[F.col(f"`{f.name}`") for f in fields], gone.alias("_gone")), cfg, now)
    if cfg.hard_deletes == "ignore":
        versions = versions.filter(~F.col("_gone"))
    names, at = [F.col(f"`{k}`") for k in key], F.col(f"`{meta.valid_from}`")
    null_safe = cfg.null_safe_key and len(key) > 1
    complete = F.lit(True) if null_safe else is_true(no_null(key))

    hashable = [F.col(f"`{f.name}`") for f in fields if not isinstance(f.dataType, T.MapType)]
    last = Window.partitionBy(*names, at).orderBy(F.xxhash64(*hashable, "_gone").desc())
    once = versions.filter(complete).withColumn("_place", F.row_number().over(last)).filter("_place = 1").drop("_place")

    # The open version of a key that changes goes in front of its changes; the others are not touched.
    touched = once.select(*names).distinct().alias("new")
    match = key_match("cur", "new", key, null_safe)
    opened, idle = (full.alias("cur").join(touched, match, how) for how in ("left_semi", "left_anti"))
    was_deleted = is_true(F.col(f"`{meta.is_deleted}`") == "True") if cfg.keeps_deleted else F.lit(False)
    line = opened.withColumns({"_old": F.lit(True), "_gone": was_deleted}).unionByName(
        once.withColumn("_old", F.lit(False)), allowMissingColumns=True
    )
    whole = Window.partitionBy(*names)
    along = whole.orderBy(at, F.col("_old").desc())
    line = line.withColumn("_start", F.max(F.when(F.col("_old"), at)).over(whole))
    line = line.filter(F.col("_old") | ~is_true(at <= F.col("_start"))).withColumns(
        {"_before": F.lag(F.struct(*columns)).over(along), "_absent": F.lag("_gone", 1, True).over(along)}
    )
    # Before its first row a key is as absent as after a deletion.
    news = F.col("_absent") | _changed_from_before([f.name for f in fields], cfg)
    kept = line.filter(F.col("_old") | F.when(F.col("_gone"), ~F.col("_absent")).otherwise(news))
    until = F.coalesce(F.lead(at).over(along), F.col(f"`{meta.valid_to}`"))
    if cfg.keeps_deleted:
        # Values come from the last version, not from the last row, which may have been none.
        kept = kept.withColumns({"_until": until, "_last": F.lag(F.struct(*columns)).over(along)})
        told = F.col("_gone") & ~F.col("_old")
        marker = surrogate([(F.col(f"_last.`{meta.scd_id}`"), T.StringType()), (at, T.TimestampNTZType())])
        own = {meta.scd_id: marker, meta.updated_at: at, meta.valid_from: at, meta.is_deleted: F.lit("True")}
        done = kept.select(
            *[
                F.col("_until").alias(c)
                if c == meta.valid_to
                else F.when(told, own.get(c, F.col(f"_last.`{c}`"))).otherwise(F.col(f"`{c}`")).alias(c)
                for c in full.columns
            ]
        )
    else:
        done = kept.withColumn(meta.valid_to, until).filter(~F.col("_gone")).select(*columns)

    alone = versions.filter(~complete & ~F.col("_gone")).drop("_gone").dropDuplicates([meta.scd_id])
    alone = alone.join(full.filter(~complete).select(meta.scd_id), meta.scd_id, "left_anti")
    result = idle.select(*columns).unionByName(done)
    return result.unionByName(alone, allowMissingColumns=True).select(*columns)


def _changed_from_before(columns: Sequence[str], cfg: Snapshot) -> Column:
    """Whether a row differs, by the strategy, from the one before it."""
    if cfg.strategy.checked is None:
        return F.lit(True)
    names = columns if cfg.strategy.checked == "all" else cfg.strategy.checked
    return any_of([~F.col(f"_before.`{c}`").eqNullSafe(F.col(f"`{c}`")) for c in names])


def with_meta(cfg: Snapshot, **names: str) -> Snapshot:
    """The same settings with some meta columns renamed."""
    return replace(cfg, meta=replace(cfg.meta, **names))


def as_of(history: DataFrame, cfg: Snapshot, moment: dt.datetime) -> DataFrame:
    """The versions valid at one moment."""
    start, end = F.col(f"`{cfg.meta.valid_from}`"), F.col(f"`{cfg.meta.valid_to}`")
    at = as_time(moment)
    return history.filter((start <= at) & (end.isNull() | (end > at)))
