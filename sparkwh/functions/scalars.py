"""Scalar expressions whose Spark built-in differs from the warehouse meaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def ts(text: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def interval(text: str) -> Column:
    """An interval literal such as ``interval("30 DAYS")``."""
    return F.expr(f"INTERVAL {text}")


def seconds(n: Column) -> Column:
    """A number of seconds as an interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def trunc_ts(unit: str, col: Column) -> Column:
    """Start of the day, hour, minute or any longer unit, without passing through a time zone."""
    day = col.cast("date").cast("timestamp_ntz")
    if unit == "day":
        return day
    if unit == "hour":
        return day + F.make_dt_interval(F.lit(0), F.hour(col))
    if unit == "minute":
        return day + F.make_dt_interval(F.lit(0), F.hour(col), F.minute(col))
    return F.trunc(col, unit).cast("timestamp_ntz")


def whole_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two zone-less timestamps."""
    return F.floor((end - start).cast("interval second").cast("decimal(20,6)")).cast("bigint")


def parse_ts(col: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to a zone-less timestamp; text that does not fit the pattern gives NULL.

    Spark's forgiving parser only makes zoned timestamps, so the text is read as UTC and counted up from the epoch.
    """
    instant = F.try_to_timestamp(F.concat(col, F.lit(" Z")), F.lit(fmt + " X"))
    since = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return ts("1970-01-01") + seconds(since)


def int_ratio(a: Column, b: Column) -> Column:
    """Whole-number quotient, NULL where the divisor is zero."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def round_cast(col: Column, from_type: T.DataType, to: str) -> Column:
    """Cast to an integer type by rounding where Spark's own cast would cut.

    Floating point rounds half to even, decimals half away from zero.
    """
    if isinstance(from_type, (T.FloatType, T.DoubleType)):
        return F.rint(col).cast(to)
    if isinstance(from_type, T.DecimalType):
        return F.round(col, 0).cast(to)
    return col.cast(to)


def value_bytes(col: Column, data_type: T.DataType) -> Column:
    """Bytes that a value takes in a row in memory, beyond the eight that every column has there."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        size = F.octet_length(col).cast("bigint")
    elif isinstance(data_type, T.ArrayType):
        inner = data_type.elementType
        size = F.size(col).cast("bigint") * 8
        if not value_is_fixed(inner):
            size = size + F.aggregate(col, F.lit(0).cast("bigint"), lambda total, x: total + value_bytes(x, inner))
    elif isinstance(data_type, T.MapType):
        size = sum((value_bytes(part(col), T.ArrayType(kind)) for part, kind in
                    ((F.map_keys, data_type.keyType), (F.map_values, data_type.valueType))), F.lit(0).cast("bigint"))
    elif isinstance(data_type, T.StructType):
        size = sum((8 + value_bytes(col.getField(f.name), f.dataType) for f in data_type.fields), F.lit(0).cast("bigint"))
    elif isinstance(data_type, T.VariantType):
        size = F.octet_length(F.to_json(col)).cast("bigint")
    else:
        size = F.lit(0 if value_is_fixed(data_type) else 16).cast("bigint")
    return F.coalesce(F.when(col.isNotNull(), size), F.lit(0).cast("bigint"))


def value_is_fixed(data_type: T.DataType) -> bool:
    """Whether values of the type fit the eight bytes that every column has in a row."""
    if isinstance(data_type, T.DecimalType):
        return data_type.precision <= 18
    return not isinstance(data_type, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))


def row_hash(columns: list[str]) -> Column:
    """A hash of the whole row: a deterministic salt that splits ties and hot keys the same way on every retry."""
    return F.xxhash64(*[F.col(c) for c in columns])
