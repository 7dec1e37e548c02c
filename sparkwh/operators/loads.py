"""Incremental loads. Each takes DataFrames and returns the rows to add, or the new state of the target.

"Now" is always the argument ``as_of``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbering import with_position
from ..functions.scalars import interval, trunc_ts, ts
from .filters import differs, recent
from .joins import asked_for, checked_small, missing, missing_within
from .reports import latest_version

# The smallest value a mark can have, and the step to the next larger one.
_LOWEST_TS = "0001-01-01 00:00:00"
_LOWEST_ID = -(1 << 63)


def _next_after(target: DataFrame, col: str, step: Column, lowest: Column) -> Column:
    """First value after the target's high-water mark, as a scalar sub-query that reaches the source's file scan."""
    return target.agg(F.coalesce(F.max(col) + step, lowest).alias("_from")).scalar()


def _on(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def incremental_by_timestamp(source: DataFrame, target: DataFrame, ts_col: str, as_of: str,
                             mark_col: str | None = None, lookback: str | None = None,
                             keys: list[str] | None = None) -> DataFrame:
    """Source rows later than the target's mark and not later than ``as_of``; everything up to ``as_of`` when the
    target is empty.

    The mark is the largest ``ts_col`` already loaded (``mark_col`` names another column). Rows that arrive late, below
    the mark, are picked up when ``lookback`` says how far back to look; ``keys`` then keeps out what is loaded.
    """
    if lookback is not None and not keys:
        raise ValueError("lookback needs the keys that tell loaded rows apart")
    step = interval("1 MICROSECOND" if lookback is None else "0 SECONDS")
    if lookback is not None:
        step = step - interval(lookback)
    low = _next_after(target, mark_col or ts_col, step, ts(_LOWEST_TS))
    rows = source.where((F.col(ts_col) >= low) & (F.col(ts_col) <= ts(as_of)))
    return rows if lookback is None else missing(rows, target, keys)


def incremental_by_id(source: DataFrame, target: DataFrame, id_col: str, fill_gaps: bool = False) -> DataFrame:
    """Source rows with an id above the target's largest; all of them when the target is empty.

    Ids below the mark that the target lacks are skipped, unless ``fill_gaps`` compares the ids themselves.
    """
    if fill_gaps:
        return missing(source, target, [id_col])
    one, lowest = F.lit(1).cast("bigint"), F.lit(_LOWEST_ID).cast("bigint")
    above = source.where(F.col(id_col) >= _next_after(target, id_col, one, lowest))
    # A first load takes rows without an id as well; row groups that have none are skipped by their NULL count.
    first = target.agg(F.max(id_col).isNull().alias("_first")).scalar()
    return above.unionByName(source.where(F.col(id_col).isNull() & first))


def classify_changes(source: DataFrame, target: DataFrame, keys: list[str], compare: list[str], as_of: str,
                     window: str | None = None, created_col: str = "created_at", null_safe: bool = True,
                     detect_deletes: bool = False, version_col: str | None = None, tiebreak: list[str] | None = None,
                     small: bool = False) -> DataFrame:
    """Source rows with ``operation_type`` INSERT, UPDATE or UNCHANGED, and ``processed_at``.

    ``window`` keeps only rows created in that span, plus all that differ. ``detect_deletes`` adds the target rows whose
    key left the source, as DELETE. Of source rows with one key the newest by ``version_col`` and ``tiebreak`` counts; without
    a version column a repeated key is an error. ``small`` vouches for a source that fits every task.
    """
    if version_col is not None:
        source = latest_version(source, keys, version_col, tiebreak or [])
    else:
        source = one_row_per_key(source, keys)
    marked = asked_for(target.select(*keys, *compare), source, keys, small).withColumn("_there", F.lit(True))
    joined = source.alias("s").join(marked.alias("t"), _on("s", "t", keys), "left")
    there, changed = F.col("t._there").isNotNull(), differs("s", "t", compare, null_safe)
    if window is not None:
        joined = joined.where((F.col(f"s.{created_col}") > ts(as_of) - interval(window)) | (there & changed))
    kept = [c for c in source.columns if c != created_col]
    kind = F.when(~there, "INSERT").when(changed, "UPDATE").otherwise("UNCHANGED")
    stamped = joined.select(*[F.col(f"s.{c}") for c in kept], kind.alias("operation_type"),
                            ts(as_of).alias("processed_at"))
    if not detect_deletes:
        return stamped
    gone = missing(target, source, keys)
    return stamped.unionByName(gone.select(*kept, F.lit("DELETE").alias("operation_type"),
                                           ts(as_of).alias("processed_at")))


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself, failing at run time if a key without NULLs occurs twice. The count is a sub-query over the key
    columns alone."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    repeated = df.where(~has_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias("_most"))
    message = F.lit(f"more than one source row for a value of {', '.join(keys)}")
    return df.where(F.when(repeated.scalar() > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def _is_newer(newer: str | list[str]) -> Column:
    """Whether the change ``c`` is later than the target row ``t`` by the version columns, taken in order; a target row
    without a version is earlier than any."""
    names = [newer] if isinstance(newer, str) else list(newer)
    later = F.struct(*[F.col(f"c.{n}") for n in names]) > F.struct(*[F.col(f"t.{n}") for n in names])
    return F.col(f"t.{names[0]}").isNull() | F.coalesce(later, F.lit(False))


def _carried(cols: list[str], newer: str | list[str] | None) -> list[str]:
    return sorted(set(cols) | set([newer] if isinstance(newer, str) else newer or []))


def update_from(target: DataFrame, changes: DataFrame, keys: list[str], cols: list[str],
                touch: dict[str, Column] | None = None, newer: str | list[str] | None = None,
                small: bool = False, check: bool = True) -> DataFrame:
    """The target with ``cols`` overwritten where the changes have its key; ``touch`` sets further columns there.

    ``newer`` names version columns: rows already at that version or later stay, the others take it too. A batch that is
    ``small`` is broadcast and the target stays where it is; else both are shuffled, and as this is a left join, Spark can
    split what is skewed on the target's side. A key twice in the changes is an error; ``check=False`` skips that test.
    """
    touch = touch or {}
    carried = _carried(cols, newer)
    changes = one_row_per_key(changes, keys) if check else changes
    batch = changes.select(*keys, *[c for c in carried if c not in keys], F.lit(True).alias("_hit"))
    joined = target.alias("t").join((checked_small(batch) if small else batch).alias("c"), _on("t", "c", keys), "left")
    hit = F.col("c._hit").isNotNull()
    if newer:
        hit = hit & _is_newer(newer)

    def result(name: str) -> Column:
        old = F.col(f"t.{name}")
        if name in touch:
            return F.when(hit, touch[name]).otherwise(old).alias(name)
        if name in carried:
            return F.when(hit, F.col(f"c.{name}")).otherwise(old).alias(name)
        return old
    return joined.select(*[result(c) for c in target.columns])


def shaped_like(df: DataFrame, target: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """``df`` with the target's columns: by name, then from ``extra``, else NULL."""
    def column(field: T.StructField) -> Column:
        if field.name in extra:
            return extra[field.name].cast(field.dataType).alias(field.name)
        if field.name in df.columns:
            return F.col(field.name).cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)
    return df.select(*[column(f) for f in target.schema.fields])


def _no_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _met(target: DataFrame, changes: DataFrame, keys: list[str], check: bool) -> DataFrame:
    """Target ``t`` and changes ``c`` met by key in one full outer join, with ``_old`` and ``_new`` telling who is there. Rows
    with a NULL in their key meet nothing and are left out.

    The test for repeated keys is a window over the keys, which needs the same shuffle and order as the join: one per side.
    """
    changes = changes.where(_no_null(keys)).withColumn("_new", F.lit(True))
    if check:
        count = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        message = F.lit(f"more than one source row for a value of {', '.join(keys)}")
        single = F.when(F.col("_count") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        changes = changes.withColumn("_count", count).where(single).drop("_count")
    there = target.where(_no_null(keys)).withColumn("_old", F.lit(True))
    return there.alias("t").join(changes.alias("c"), _on("t", "c", keys), "full")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           touch: dict[str, Column] | None = None, newer: str | list[str] | None = None, check: bool = True,
           small: bool = False) -> DataFrame:
    """The target with matching rows overwritten and new rows added; ``touch`` is set on both.

    A key twice in the source is an error, as it is for any upsert; ``check=False`` skips that test for sources known to
    be unique. Rows with a NULL in their key match nothing: they stay, or are added. Source and target are read and
    shuffled once each. With ``small``, which vouches for a source that fits every task, the source is broadcast instead
    and the target is not shuffled.
    """
    touch = touch or {}
    if small:
        source = one_row_per_key(source, keys) if check else source
        updated = update_from(target, source, keys, update_cols, touch, newer, True, check=False)
        return updated.unionByName(shaped_like(missing(source, target, keys, True), target, touch))
    return _merged(target, source, keys, update_cols, touch, newer, check)


def _merged(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str], touch: dict[str, Column],
            newer: str | list[str] | None, check: bool, keep: Column | None = None) -> DataFrame:
    """One full outer join: old rows, overwritten where met, and new ones. ``keep`` drops joined rows."""
    carried = _carried(update_cols, newer)
    met = _met(target, source, keys, check)
    met = met if keep is None else met.where(keep)
    old = F.col("t._old").isNotNull()
    hit = old & F.col("c._new").isNotNull()
    if newer:
        hit = hit & _is_newer(newer)

    def result(field: T.StructField) -> Column:
        name = field.name
        before, after = F.col(f"t.{name}"), F.col(f"c.{name}") if name in source.columns else F.lit(None)
        added = touch[name] if name in touch else after
        changed = touch[name] if name in touch else after if name in carried else before
        return (F.when(~old, added.cast(field.dataType)).when(hit, changed.cast(field.dataType)).otherwise(before)).alias(name)
    joined = met.select(*[result(f) for f in target.schema.fields])
    none = ~_no_null(keys)
    loose = source.where(none) if "operation_type" not in source.columns or keep is None else source.where(none & (F.col("operation_type") == "INSERT"))
    return joined.unionByName(target.where(none)).unionByName(shaped_like(loose, target, touch))


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], update_cols: list[str],
                  touch: dict[str, Column] | None = None, check: bool = True) -> DataFrame:
    """Apply one classified batch (see ``classify_changes``): add INSERT rows, overwrite UPDATE rows, drop DELETE rows.

    An UPDATE or DELETE whose key the target lacks does nothing, an INSERT whose key it has overwrites. A key twice in the
    batch is an error. Target and changes are read and shuffled once each.
    """
    kind, old = F.col("c.operation_type"), F.col("t._old").isNotNull()
    keep = F.when(old, F.coalesce(kind != "DELETE", F.lit(True))).otherwise(kind == "INSERT")
    return _merged(target, changes.where("operation_type IN ('INSERT', 'UPDATE', 'DELETE')"), keys, update_cols, touch or {}, None, check, keep)


def purge_staging(staging: DataFrame, as_of: str, older_than: str = "1 HOUR",
                  ts_col: str = "processed_at") -> DataFrame:
    """The staging rows that stay: those processed within the span, and those without a time."""
    return delete_where(staging, F.col(ts_col) < ts(as_of) - interval(older_than))


def delta_load(source: DataFrame, target: DataFrame, keys: list[str], version_col: str, as_of: str,
               tiebreak: list[str], window: str = "1 HOUR", tolerance: str = "5 MINUTES",
               target_version_col: str | None = None, small: bool = False) -> DataFrame:
    """Newest recent version per key, unless the target holds one that is at most ``tolerance`` older. ``small`` vouches for a
    window whose keys fit every task; the source is read once without it."""
    newest = latest_version(recent(source, version_col, as_of, window), keys, version_col, tiebreak)
    return missing_within(newest, target, keys, version_col, target_version_col or version_col, tolerance, small)


def batch_assign(source: DataFrame, target: DataFrame, id_col: str, batch_size: int = 1000,
                 tiebreak: list[str] | None = None) -> DataFrame:
    """The rows still to load with ``batch_no`` 0, 1, ...: consecutive ids, ``batch_size`` rows each.

    One numbering pass replaces the page-by-page loop. Every row above the target's largest id is in exactly one batch.
    """
    pending = incremental_by_id(source, target, id_col)
    placed = with_position(pending, [id_col, *(tiebreak or [])], "_position")
    return placed.withColumn("batch_no", F.call_function("div", "_position", F.lit(batch_size))).drop("_position")


def default_fill(df: DataFrame, col: str, value: Column) -> DataFrame:
    """``value`` where the column is NULL."""
    return df.withColumn(col, F.coalesce(F.col(col), value))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows a DELETE leaves: those for which the predicate is false or unknown."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def daily_transform(staging: DataFrame, as_of: str) -> DataFrame:
    """Sales since the start of yesterday, stamped with the processing time."""
    today = trunc_ts("day", ts(as_of))
    return (staging.where(F.col("sale_date") >= today - interval("1 DAY"))
            .select("sale_id", "customer_id", "product_id", "sale_amount", "sale_date", "region", "store_id",
                    ts(as_of).alias("processed_at")))


def load_history(history: DataFrame, as_of: str, span: str = "24 HOURS") -> DataFrame:
    """Loads of the last span, newest first."""
    return (recent(history, "call_time", as_of, span)
            .select("procedure_name", "call_time", "total_time", "rows_processed", "success_flag")
            .orderBy(F.col("call_time").desc(), "procedure_name", "rows_processed"))
