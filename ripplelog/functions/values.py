"""Values as they are written: booleans, JSON, times, binaries. Plain column expressions, so Spark compiles them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UTC_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def boolean(c: Column) -> Column:
    """null stays null, zero is 0, all else 1."""
    return F.when(c.isNotNull(), (c.cast("long") != 0).cast("int"))


def json_text(c: Column, null_as_text: bool = False, kind: T.DataType | None = None) -> Column:
    """JSON as text; null stays null, or becomes the text null on request.

    kind: the column's type, where it isn't text: bytes are UTF-8, structs, maps and arrays are written as JSON, with all
    bytes in them as text.
    """
    if isinstance(kind, T.BinaryType):
        c = F.decode(c, "UTF-8")
    elif isinstance(kind, T.StructType | T.MapType | T.ArrayType):
        c = F.to_json(c.cast(_without_bytes(kind)))
    return F.coalesce(c, F.lit("null")) if null_as_text else c


def _without_bytes(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.BinaryType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _without_bytes(f.dataType), f.nullable) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_without_bytes(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(_without_bytes(kind.keyType), _without_bytes(kind.valueType), kind.valueContainsNull)
    return kind


def utc_text(c: Column) -> Column:
    """YYYY-MM-DD HH:MM:SS.ffffff; the session's time zone has to be UTC."""
    return F.date_format(c, UTC_FORMAT)


def date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970, down for fractions. A time without zone is UTC."""
    return F.unix_seconds(c.cast("timestamp"))


def epoch_micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def duration_text(seconds: Column) -> Column:
    """H:MM:SS, with days before it from a day on, and a negative number of days for what is below zero."""
    days, rest = F.floor(seconds / 86_400), F.pmod(seconds, F.lit(86_400))
    clock = F.format_string("%d:%02d:%02d", F.floor(rest / 3600).cast("long"), F.floor(rest % 3600 / 60).cast("long"), (rest % 60).cast("long"))
    named = F.concat(days.cast("long").cast("string"), F.when(F.abs(days) == 1, " day, ").otherwise(" days, "), clock)
    return F.when(days == 0, clock).otherwise(named)


def zero_date_to_null(text: Column, as_type: str = "timestamp") -> Column:
    """Dates such as 0000-00-00 are null; so is what can't be read."""
    return F.when(~text.startswith("0000-00-00"), text).try_cast(as_type)


def binary_text(c: Column, how: str = "plain", strip_nul: bool = False, null_as_nul: bool = False) -> Column:
    """A binary as UTF-8 text (bytes that aren't UTF-8 fail), upper-case hexadecimal, or base64.

    strip_nul takes zero bytes off both ends; null_as_nul writes null as one zero byte.
    """
    c = F.coalesce(c, F.unhex(F.lit("00"))) if null_as_nul else c
    c = F.btrim(c, F.unhex(F.lit("00"))) if strip_nul else c
    return {"plain": lambda: F.decode(c, "UTF-8"), "hex": lambda: F.hex(c), "base64": lambda: F.base64(c)}[how]()


def identifier(c: Column) -> Column:
    """Without back-quotes, in upper case."""
    return F.upper(F.regexp_replace(c, "`", ""))


def normalised(field: T.StructField, binary: str = "plain") -> Column:
    """A field as it is exported, by its type."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        out = boolean(c)
    elif isinstance(field.dataType, T.BinaryType):
        out = binary_text(c, binary)
    elif isinstance(field.dataType, T.DayTimeIntervalType):
        out = duration_text((F.extract(F.lit("DAY"), c) * 86_400 + F.extract(F.lit("HOUR"), c) * 3600 + F.extract(F.lit("MINUTE"), c) * 60 + F.floor(F.extract(F.lit("SECOND"), c))).cast("long"))
    elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
        out = utc_text(c)
    elif isinstance(field.dataType, T.DateType):
        out = date_text(c)
    elif isinstance(field.dataType, T.StructType | T.MapType | T.ArrayType):
        out = json_text(c, kind=field.dataType)
    else:
        out = c
    return out.alias(field.name)


def date_chunks(start: Column, end: Column, days: int) -> Column:
    """Arrays of (start, end): the range in pieces of so many days, the last one shorter."""
    firsts = F.sequence(start, end, F.expr(f"INTERVAL {int(days)} DAYS"))
    return F.transform(firsts, lambda d: F.struct(d.alias("start"), F.least(F.date_add(d, days - 1), end).alias("end")))


def even_date_chunks(start: Column, end: Column, most: int) -> Column:
    """Arrays of (start, end): the range in as few equal pieces of at most `most` days as there can be, each one beginning on
    the day on which the one before ends; with most=0 every day but the last by itself."""
    days = F.datediff(end, start)
    piece = lambda a, b: F.struct(F.date_add(start, a.cast("int")).alias("start"), F.date_add(start, b.cast("int")).alias("end"))
    if most == 0:
        return F.transform(F.sequence(F.lit(0), F.greatest(days - 1, F.lit(0))), lambda i: piece(i, i))
    parts = F.greatest(F.ceil(days / most), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: piece(F.floor(days * i / parts), F.floor(days * (i + 1) / parts)))


def moment(text: Column, now: Column) -> Column:
    """A date or time as text, or one before `now`: today, yesterday, or a number of minutes, hours, days, weeks, months or
    years ago. Null for other texts."""
    said = F.lower(F.trim(text))
    pattern = r"^(\d{1,6})\s+(minute|hour|day|week|month|year)s?\s+ago$"
    n, unit = F.regexp_extract(said, pattern, 1).try_cast("int"), F.regexp_extract(said, pattern, 2)
    zero = F.lit(0)
    ago = (
        F.when(unit == "minute", now - F.make_dt_interval(zero, zero, n, F.lit(0.0)))
        .when(unit == "hour", now - F.make_dt_interval(zero, n, zero, F.lit(0.0)))
        .when(unit == "day", now - F.make_dt_interval(n, zero, zero, F.lit(0.0)))
        .when(unit == "week", now - F.make_dt_interval(7 * n, zero, zero, F.lit(0.0)))
        .when(unit == "month", now - F.make_ym_interval(zero, n))
        .when(unit == "year", now - F.make_ym_interval(n, zero))
    )
    return F.when(said.isin("today", "now"), now).when(said == "yesterday", now - F.expr("INTERVAL 1 DAY")).when(unit != "", ago).otherwise(text.try_cast("timestamp_ntz"))


def date_period(start: Column, end: Column, now: Column) -> Column:
    """(start, end) of two texts as moment() reads them; fails where the start is behind the end."""
    a, b = moment(start, now), moment(end, now)
    wrong = F.raise_error(F.concat(F.lit("the start is behind the end: "), start, F.lit(", "), end)).cast("timestamp_ntz")
    return F.struct(F.when(a > b, wrong).otherwise(a).alias("start"), b.alias("end"))


def backfill_period(start: Column, end: Column, last: Column, now: Column) -> Column:
    """The next (start, end) of a load in steps: the given period at first, where `last` is null; then as many days from the
    end of the last one, one at least, up to now."""
    days = F.greatest(F.datediff(last["end"], last["start"]), F.lit(1))
    then = last["end"].cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), F.lit(0.0))
    late = F.to_date(then) >= F.date_add(F.to_date(now), 1)
    following = F.struct(last["end"].cast("timestamp_ntz").alias("start"), F.when(late, now).otherwise(then).alias("end"))
    return F.when(last.isNull(), date_period(start, end, now)).otherwise(following)
