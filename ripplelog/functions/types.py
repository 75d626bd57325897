"""Server column types as Spark types and as storage base types."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of the integer types, and the server types by kind.
INTEGER_BYTES = {"tinyint": 1, "smallint": 2, "mediumint": 3, "int": 4, "bigint": 8}
STRINGS = ("char", "enum", "longtext", "mediumtext", "text", "varchar")
BLOBS = ("tinyblob", "blob", "mediumblob")
BINARIES = ("binary", "varbinary")
FLOATS = ("float", "double")

# Storage base types by the beginning of the server type, tried in this order.
BASE_TYPES = (
    ("STRING", ("char", "enum", "longtext", "mediumtext", "text", "varchar", "json", "binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob", "set", "year")),
    ("INTEGER", ("tinyint", "smallint", "mediumint", "int", "bigint")),
    ("TIMESTAMP", ("datetime", "timestamp", "time")),
    ("FLOAT", ("float", "double")),
    ("BOOLEAN", ("bit", "bool")),
    ("DATE", ("date",)),
    ("NUMERIC", ("decimal", "numeric")),
)


def base_name(column_type: str) -> str:
    return re.match(r"\s*(\w*)", column_type.lower())[1]


def size_of(column_type: str) -> tuple[int | None, int | None]:
    """The numbers in brackets: length or precision, and scale."""
    found = re.search(r"\((\d+)(?:\s*,\s*(\d+))?\)", column_type)
    return (int(found[1]), int(found[2]) if found[2] else None) if found else (None, None)


def spark_type(column_type: str) -> T.DataType | None:
    """The Spark type of a server type, None where it isn't read.

    Unsigned integers take the next wider type, unsigned bigint a decimal; decimals beyond 38 digits are text; a time of
    day can be longer than a day and is an interval.
    """
    name, unsigned = base_name(column_type), "unsigned" in column_type.lower()
    if name == "bit" or name == "tinyint" and size_of(column_type)[0] == 1:
        return T.BooleanType()
    if name in INTEGER_BYTES:
        if name == "bigint":
            return T.DecimalType(20, 0) if unsigned else T.LongType()
        wide = {1: (T.ByteType, T.ShortType), 2: (T.ShortType, T.IntegerType), 3: (T.IntegerType, T.IntegerType), 4: (T.IntegerType, T.LongType)}
        return wide[INTEGER_BYTES[name]][unsigned]()
    if name in FLOATS:
        return T.FloatType() if name == "float" else T.DoubleType()
    if name == "decimal":
        digits, scale = size_of(column_type)
        return T.StringType() if (digits or 10) > 38 else T.DecimalType(digits or 10, scale or 0)
    if name in (*STRINGS, "json", "set"):
        return T.StringType()
    if name in (*BLOBS, *BINARIES):
        return T.BinaryType()
    return {"date": T.DateType(), "datetime": T.TimestampNTZType(), "timestamp": T.TimestampType(), "time": T.DayTimeIntervalType()}.get(name)


def integer_range(column_type: str) -> tuple[int, int] | None:
    name = base_name(column_type)
    if name not in INTEGER_BYTES:
        return None
    bits = 8 * INTEGER_BYTES[name]
    return (0, 2**bits - 1) if "unsigned" in column_type.lower() else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)


def inclusion(column_type: str, key: str) -> str:
    """automatic for primary keys, unsupported where the type isn't read, else available."""
    return "automatic" if key == "PRI" else "unsupported" if spark_type(column_type) is None else "available"


def base_type(column_type: Column) -> Column:
    """The storage base type by the beginning of the server type; null if none fits."""
    lower, out = F.lower(column_type), F.lit(None).cast("string")
    for name, starts in reversed(BASE_TYPES):
        out = F.when(lower.rlike(f"^({'|'.join(starts)})"), name).otherwise(out)
    return out


def base_type_of(field: T.StructField) -> str:
    """The storage base type of a field: by its server type where that is known, else by its Spark type."""
    if known := (field.metadata or {}).get("column_type"):
        for name, starts in BASE_TYPES:
            if known.lower().startswith(starts):
                return name
    kind = field.dataType
    for name, kinds in (("INTEGER", T.IntegralType), ("NUMERIC", T.DecimalType), ("FLOAT", T.FractionalType), ("BOOLEAN", T.BooleanType), ("DATE", T.DateType), ("TIMESTAMP", (T.TimestampType, T.TimestampNTZType))):
        if isinstance(kind, kinds):
            return name
    return "STRING"


@dataclass(frozen=True)
class ServerColumn:
    """One row of the server's column catalogue."""

    name: str
    column_type: str
    ordinal: int
    key: str = ""
    charset: str | None = None
    nullable: bool = True

    def field(self) -> T.StructField:
        """The column as a Spark field; sizes, ranges, charset and inclusion travel as metadata."""
        length, scale = size_of(self.column_type)
        known = {"inclusion": inclusion(self.column_type, self.key), "column_type": self.column_type, "charset": self.charset, "length": length, "scale": scale}
        if limits := integer_range(self.column_type):
            known |= dict(zip(("minimum", "maximum"), map(str, limits), strict=True))
        return T.StructField(self.name, spark_type(self.column_type) or T.StringType(), self.nullable and self.key != "PRI", {k: v for k, v in known.items() if v is not None})


def struct_type(columns: list[ServerColumn]) -> T.StructType:
    """The columns that are read, by ordinal position."""
    return T.StructType([c.field() for c in sorted(columns, key=lambda c: c.ordinal) if spark_type(c.column_type) is not None])
