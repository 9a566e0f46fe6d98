"""Upserts and slowly changing dimensions, computed as new table contents.

Every merge walks the target once in a left join to the source.  With a small
source Spark broadcasts it and the target is not shuffled at all; with a large
one the join shuffles both and adaptive execution can split a hot target key,
which a full outer join would not allow.  A source that repeats a key is refused
while the plan runs, by an aggregate of its keys; ``unique=False`` leaves that out
for sources that are known to hold each key once.  Rows with a NULL key never match
and may repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import stamp
from millrace.functions.conform import fill_columns

ACTION = "action"
_COPY, _APPLY, _HIT = "__copy", "__apply", "__hit"


def t(name: str) -> Column:
    """A column of the merge target."""
    return F.col(f"t.`{name}`")


def s(name: str) -> Column:
    """A column of the merge source."""
    return F.col(f"s.`{name}`")


def same_keys(on: Mapping[str, str]) -> Column:
    return reduce(Column.__and__, [t(mine) == s(theirs) for mine, theirs in on.items()])


def any_differs(columns: Mapping[str, str] | Sequence[str], null_is_change: bool = False) -> Column:
    """True if any tracked column differs between target and source, NULL-safe.

    With ``null_is_change`` two NULLs count as a change.
    """
    tests = []
    for mine, theirs in on_map(columns).items():
        tests.append(f"NOT (t.`{mine}` <=> s.`{theirs}`)")
        if null_is_change:
            tests.append(f"(t.`{mine}` IS NULL AND s.`{theirs}` IS NULL)")
    return F.expr(" OR ".join(tests))


def on_map(on: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {name: name for name in on}


def key_counts(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source's keys without NULL, each once, with how often it occurs."""
    return source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__times"))


def unseen(source: DataFrame, target: DataFrame, on: Mapping[str, str], counted: DataFrame | None = None) -> DataFrame:
    """Source rows whose key the target lacks.

    The target's keys are first cut down to those the source has, by a semi join
    with the source as the small side, so the target's own key column is not
    shuffled when the source fits a broadcast.  ``counted`` are the source's keys, if they are known.
    """
    theirs = list(on.values())
    keys = (source if counted is None else counted).select(*theirs)
    touched = target.select(*[F.col(mine).alias(name) for mine, name in on.items()])
    touched = touched.join(keys, theirs, "left_semi").distinct()
    return source.join(touched, theirs, "left_anti")


def refuse_repeated(source: DataFrame, keys: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """``source``, failing at run time if two rows share a key without NULL.

    The check is a scalar subquery, so the planner still sees the source's own size.
    """
    times = key_counts(source, keys) if counted is None else counted
    example = times.filter("__times > 1").agg(F.max(F.to_json(F.struct(*keys)))).scalar()
    refused = F.raise_error(F.concat(F.lit("merge source has a repeated key: "), example)).cast("boolean")
    return source.filter(F.when(example.isNotNull(), refused).otherwise(True))


def _kind(frame: DataFrame, name: str) -> T.DataType:
    return frame.schema[name].dataType


def _cell(frame: DataFrame, name: str, value: Column | None) -> Column:
    column = F.lit(None) if value is None else value
    return column.cast(_kind(frame, name)).alias(name)


def _marked(target: DataFrame, source: DataFrame, condition: Column, on: Mapping[str, str], when: Column | None) -> DataFrame:
    """Target left join source, with whether a row was hit and whether to change it.

    Both are columns of their own, so a long comparison is evaluated once per row
    and not once per output column.
    """
    hit = s(next(iter(on.values()))).isNotNull()
    apply = hit if when is None else hit & F.coalesce(when, F.lit(False))
    joined = target.alias("t").join(source.alias("s"), condition, "left")
    return joined.withColumns({_HIT: hit, _APPLY: apply})


def merge(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str],
          update: Mapping[str, Column], insert: Mapping[str, Column] | None,
          when: Column | None = None, labels: Sequence[str] = ("NOT MATCHED", "SAME", "UPDATED", "INSERT"),
          action: str | None = ACTION, unique: bool = True) -> DataFrame:
    """Target after the merge, each row labelled with what happened to it.

    ``update`` and ``insert`` map target columns to expressions over
    :func:`t` and :func:`s`; ``when`` guards the update.  Columns ``update``
    does not name keep the target's value, columns ``insert`` does not name are
    NULL.  ``insert=None`` adds no rows.
    """
    on = on_map(on)
    counted = key_counts(source, list(on.values())) if unique else None
    checked = refuse_repeated(source, list(on.values()), counted) if unique else source
    not_matched, same, updated, inserted = labels
    joined = _marked(target, checked, same_keys(on), on, when)
    hit, apply = F.col(_HIT), F.col(_APPLY)
    what = F.when(apply, updated).when(hit, same).otherwise(not_matched)
    kept = joined.select(
        *[
            F.when(apply, update[c].cast(_kind(target, c))).otherwise(t(c)).alias(c) if c in update else t(c)
            for c in target.columns
        ],
        *([what.alias(action)] if action else []),
    )
    if insert is None:
        return kept
    fresh = unseen(checked, target, on, counted).alias("s").select(
        *[_cell(target, c, insert.get(c)) for c in target.columns],
        *([F.lit(inserted).alias(action)] if action else []),
    )
    return kept.unionByName(fresh)


def upsert_full(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str],
                labels: Sequence[str] = ("NOT MATCHED", "SAME", "UPDATED", "INSERT"),
                action: str | None = ACTION, unique: bool = True) -> DataFrame:
    """Replace a matched row by the whole source row; add unseen ones.

    Target columns the source lacks become NULL in replaced rows.
    """
    row = {c: s(c) if c in source.columns else F.lit(None) for c in target.columns}
    for mine, theirs in on_map(on).items():
        row[mine] = s(theirs)
    return merge(target, source, on, row, row, None, labels, action, unique)


def upsert_changed(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str],
                   tracked: Mapping[str, str] | Sequence[str], extra: Mapping[str, Column] | None = None,
                   null_is_change: bool = False, action: str | None = ACTION, unique: bool = True) -> DataFrame:
    """Update a matched row only if a tracked column differs; add unseen rows.

    ``tracked`` (target column -> source column) is compared and copied, each
    column with itself and NULL-safe.  ``extra`` is written on update and insert
    without being compared, such as load keys.
    """
    on = on_map(on)
    pairs = on_map(tracked)
    values = {mine: s(theirs) for mine, theirs in pairs.items()} | dict(extra or {})
    insert = {mine: s(theirs) for mine, theirs in on.items()} | values
    return merge(target, source, on, values, insert, any_differs(pairs, null_is_change), action=action, unique=unique)


def refresh_keep_keys(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str],
                      key: str) -> DataFrame:
    """The source's rows with the target's surrogate key where the business key was known.

    Rows only the target has vanish.  New members have a NULL key; number them
    with :func:`millrace.operators.keys.allocate_keys`.
    """
    on = on_map(on)
    keys = target.select(*on, key).alias("t")
    joined = source.alias("s").join(keys, same_keys(on), "left")
    return joined.select(t(key), *[s(c) for c in source.columns if c != key])


def insert_only(target: DataFrame, source: DataFrame, columns: Mapping[str, str] | Sequence[str],
                pad_key: tuple[str, int] | None = None) -> DataFrame:
    """Cleaned target plus the source's distinct members it lacks.

    Members are compared on all columns (target column -> source column).  The
    target loses rows with a NULL and repeated rows; new members may hold NULL.
    """
    pairs = on_map(columns)
    members = source.select(*[F.col(theirs).alias(mine) for mine, theirs in pairs.items()]).distinct()
    if pad_key:
        name, width = pad_key
        members = members.withColumn(name, F.lpad(name, width, "0"))
    fresh = unseen(members, target, {name: name for name in pairs})
    return target.dropna().dropDuplicates().unionByName(fresh, allowMissingColumns=True)


def scd2_status(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str], status: str,
                as_of, hours: int = 0, start: tuple[str, str] = ("StartDateKey", "StartTimeKey"),
                end: tuple[str, str] = ("EndDateKey", "EndTimeKey"), action: str | None = ACTION,
                unique: bool = True) -> DataFrame:
    """Close the open row of a key whose status changed and open a new one.

    A NULL on either side counts as changed.  The new row takes all it can from
    the source; other columns are NULL.  Each joined row becomes one or two
    output rows by exploding a two-element constant, so the join runs once.
    """
    on = on_map(on)
    if unique:
        source = refuse_repeated(source, list(on.values()))
    day, clock = stamp(as_of, hours)
    opened = t(start[0]).isNotNull() & t(end[0]).isNull()
    differing = ~F.coalesce(t(status) == s(status), F.lit(False))
    joined = _marked(target, source, same_keys(on) & opened, on, differing)
    hit, changed = F.col(_HIT), F.col(_APPLY)
    copies = joined.withColumn(_COPY, F.explode(F.when(changed, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    new = F.col(_COPY) == 1
    closing = changed & ~new

    key_of = {mine: theirs for mine, theirs in on.items()}

    def value(name: str) -> Column:
        if name in start:
            fresh = day if name == start[0] else clock
            return F.when(new, fresh.cast(_kind(target, name))).otherwise(t(name))
        if name in end:
            last = day if name == end[0] else clock
            return F.when(closing, last.cast(_kind(target, name))).when(~new, t(name))
        origin = key_of.get(name, name)
        if origin in source.columns:
            return F.when(new, s(origin).cast(_kind(target, name))).otherwise(t(name))
        return F.when(~new, t(name))

    what = F.when(new, "INSERT").when(changed, "UPDATED").when(hit, "SAME").otherwise("NOT MATCHED")
    return copies.select(
        *[value(c).alias(c) for c in target.columns],
        *([what.alias(action)] if action else []),
    )


def scd1_current(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str],
                 tracked: Sequence[str], keep: Sequence[str], as_of, hours: int = 0,
                 defaults: Mapping[str, object] | None = None,
                 start: tuple[str, str] = ("StartDateKey", "StartTimeKey"),
                 end: tuple[str, str] = ("EndDateKey", "EndTimeKey"),
                 load: tuple[str, str] | None = None, fill: str | None = "NA",
                 null_is_change: bool = False, action: str | None = ACTION, unique: bool = True) -> DataFrame:
    """Overwrite the open row of a key if a tracked attribute differs.

    ``keep`` names the columns an overwritten row retains (validity, surrogate
    key); its other columns come from the source or become NULL.  A key no row
    has, open or closed, is inserted and opened now.  ``defaults`` replace NULL
    attributes of the source before comparing, ``fill`` replaces NULL text of
    changed and new rows.
    """
    on = on_map(on)
    if unique:
        source = refuse_repeated(source, list(on.values()))
    if defaults:
        source = fill_columns(source, defaults)
    day, clock = stamp(as_of, hours)
    opened = t(start[0]).isNotNull() & t(end[0]).isNull()
    joined = _marked(target, source, same_keys(on) & opened, on, any_differs(tracked, null_is_change))
    apply = F.col(_APPLY)
    key_of = {mine: theirs for mine, theirs in on.items()}

    def text(name: str, value: Column) -> Column:
        is_text = isinstance(_kind(target, name), T.StringType)
        return F.coalesce(value, F.lit(fill)) if fill is not None and is_text else value

    def taken(name: str) -> Column:
        origin = key_of.get(name, name)
        value = s(origin) if origin in source.columns else F.lit(None)
        return value.cast(_kind(target, name))

    def updated(name: str) -> Column:
        if name in keep:
            return text(name, t(name))
        # Only columns the source brings are filled; bookkeeping columns become NULL.
        return text(name, taken(name)) if key_of.get(name, name) in source.columns else taken(name)

    kept = joined.select(
        *[F.when(apply, updated(c)).otherwise(t(c)).alias(c) for c in target.columns],
        *([F.when(apply, "UPDATED").otherwise("NOT MATCHED").alias(action)] if action else []),
    )
    moments = dict(zip(start, (day, clock))) | (dict(zip(load, (day, clock))) if load else {})

    def inserted(name: str) -> Column:
        if name in moments:
            return moments[name].cast(_kind(target, name))
        return text(name, taken(name)) if key_of.get(name, name) in source.columns else taken(name)

    fresh = unseen(source, target, on).alias("s").select(
        *[inserted(c).alias(c) for c in target.columns],
        *([F.lit("INSERT").alias(action)] if action else []),
    )
    return kept.unionByName(fresh)


def versioned_merge(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str], status: str, tracked: Sequence[str],
                    keep: Sequence[str], as_of, hours: int = 0, defaults: Mapping[str, object] | None = None,
                    start: tuple[str, str] = ("StartDateKey", "StartTimeKey"), end: tuple[str, str] = ("EndDateKey", "EndTimeKey"),
                    load: tuple[str, str] | None = None, fill: str | None = "NA", null_is_change: bool = False, unique: bool = True) -> DataFrame:
    """:func:`scd2_status`, then :func:`scd1_current` with the same source, by one join of the target.

    Each joined row is classified once: an open row whose status changed is closed
    and followed by a new version, an open row with other changes is overwritten, all
    others stay.  The new version is compared with the source's own defaults, as the
    second merge would.
    """
    on = on_map(on)
    counted = key_counts(source, list(on.values())) if unique else None
    checked = refuse_repeated(source, list(on.values()), counted) if unique else source
    day, clock = stamp(as_of, hours)
    key_of, defaults = {mine: theirs for mine, theirs in on.items()}, defaults or {}
    opened = t(start[0]).isNotNull() & t(end[0]).isNull()
    differing = ~F.coalesce(t(status) == s(status), F.lit(False))
    joined = _marked(target, checked, same_keys(on) & opened, on, differing)

    def raw(name: str) -> Column:
        origin = key_of.get(name, name)
        return s(origin).cast(_kind(target, name)) if origin in source.columns else F.lit(None).cast(_kind(target, name))

    def filled(name: str) -> Column:
        origin = key_of.get(name, name)
        if origin not in defaults or origin not in source.columns:
            return raw(name)
        return F.coalesce(s(origin), F.lit(defaults[origin]).cast(_kind(source, origin))).cast(_kind(target, name))

    def text(name: str, value: Column) -> Column:
        return F.coalesce(value, F.lit(fill)) if fill is not None and isinstance(_kind(target, name), T.StringType) else value

    def taken(name: str) -> Column:
        return text(name, filled(name)) if key_of.get(name, name) in source.columns else filled(name)

    def changed(old: Callable[[str], Column]) -> Column:
        tests = [~old(c).eqNullSafe(filled(c)) for c in tracked]
        tests += [old(c).isNull() & filled(c).isNull() for c in tracked] if null_is_change else []
        return reduce(Column.__or__, tests, F.lit(False))

    hit, closing, new = F.col(_HIT), F.col(_APPLY), F.col(_COPY) == 1
    # evaluated once per joined row, not once per output column
    joined = joined.withColumns({"__overwrite": hit & ~closing & changed(t), "__refill": closing & changed(raw)})
    copies = joined.withColumn(_COPY, F.explode(F.when(closing, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    now = dict(zip(start, (day, clock)))
    last = dict(zip(end, (day, clock)))

    def fresh_version(name: str) -> Column:
        value = now[name].cast(_kind(target, name)) if name in now else F.lit(None).cast(_kind(target, name)) if name in end else raw(name)
        return F.when(F.col("__refill"), text(name, value) if name in keep else taken(name)).otherwise(value)

    def old_version(name: str) -> Column:
        value = F.when(F.col("__overwrite"), text(name, t(name)) if name in keep else taken(name))
        value = value.when(closing, last[name].cast(_kind(target, name))) if name in last else value
        return value.otherwise(t(name))

    kept = copies.select(*[F.when(new, fresh_version(c)).otherwise(old_version(c)).alias(c) for c in target.columns])
    moments = now | (dict(zip(load, (day, clock))) if load else {})
    fresh = unseen(checked, target, on, counted).alias("s").select(
        *[(moments[c].cast(_kind(target, c)) if c in moments else taken(c)).alias(c) for c in target.columns])
    return kept.unionByName(fresh)
