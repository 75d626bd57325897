"""Tables of versions in a folder. A version is a list of Parquet folders, of which only those that changed are new."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.sources.sinks import delete, read_text, write_text

PART = "_part"


class VersionedTable:
    """A table of versions, with a small file that points to the present one.

    A version lists its parts: names, and the folder that each one is in. Without a key the one part is the whole table, and
    added rows are further parts. With a key, rows are dealt to `buckets` parts by a hash of it, and an upsert writes anew
    the parts that its rows fall in; the others are those of the version before. The file of a version is written when its
    rows are there, and the pointer moves last: nobody reads half of a version, and one that is written again, as a repeated
    batch does, starts from the same version before it.
    """

    def __init__(self, spark: SparkSession, path: str, key: Iterable[str] = (), buckets: int = 1):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    def _pointer(self) -> dict:
        text = read_text(self.spark, f"{self.path}/CURRENT")
        return json.loads(text) if text else {}

    def version(self) -> int | None:
        return self._pointer().get("version")

    def previous(self) -> int | None:
        return self._pointer().get("previous")

    def token(self) -> str | None:
        """What the writer of the present version said that it is made of."""
        return self._pointer().get("token")

    def content(self, version: int | None = None) -> dict | None:
        """parts (folders by name), schema, key and buckets of a version, by default the present one."""
        version = self.version() if version is None else version
        text = None if version is None else read_text(self.spark, f"{self.path}/versions/{version}.json")
        return json.loads(text) if text else None

    def _rows(self, content: dict, parts: Iterable[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(content["schema"])
        folders = [f for p, f in content["parts"].items() if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame | None:
        content = self.content(version)
        return None if content is None else self._rows(content)

    def _base(self, version: int) -> dict | None:
        """The version that `version` follows: the one before it, if it was written already."""
        at = self._pointer()
        return self.content(at.get("previous") if at.get("version") == version else at.get("version")) if at else None

    def _publish(self, version: int, content: dict, token: str | None) -> None:
        at = self._pointer()
        before = at.get("previous") if at.get("version") == version else at.get("version")
        write_text(self.spark, f"{self.path}/versions/{version}.json", json.dumps(content))
        write_text(self.spark, f"{self.path}/CURRENT", json.dumps({"version": version, "previous": before, "token": token}))

    def _content(self, parts: dict[str, str], schema: T.StructType) -> dict:
        return {"parts": parts, "schema": schema.jsonValue(), "key": self.key, "buckets": self.buckets}

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(buckets)).cast("int")

    def _write_parts(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").partitionBy(PART).parquet(f"{self.path}/v={version}")

    def write(self, rows: DataFrame, version: int, token: str | None = None) -> None:
        """All rows anew."""
        if not self.key or self.buckets == 1:
            rows.write.mode("overwrite").parquet(f"{self.path}/v={version}")
            parts = {"0": f"v={version}"}
        else:
            self._write_parts(rows.withColumn(PART, self._bucket(self.buckets)).repartition(self.buckets, PART), version)
            parts = {str(i): f"v={version}/{PART}={i}" for i in self._numbers(f"v={version}", f"{PART}=")}
        self._publish(version, self._content(parts, rows.schema), token)

    def add(self, rows: DataFrame, version: int, token: str | None = None) -> None:
        """Rows beside those there are, which stay where they are."""
        base = self._base(version)
        rows.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        parts = {**(base["parts"] if base else {}), f"+{version}": f"v={version}"}
        schema = _grown(T.StructType.fromJson(base["schema"]), rows.schema) if base else rows.schema
        self._publish(version, self._content(parts, schema), token)

    def upsert(self, changes: DataFrame, version: int, key: Iterable[str] | None = None, order: Column | None = None, token: str | None = None) -> None:
        """The version before with the rows of `changes` in place of those with their keys. Of rows with one key the last by
        `order` stays, be it new or old; without an order `changes` has one row for each key, which stays."""
        self.key = list(key) if key is not None else self.key
        base = self._base(version)
        buckets = base["buckets"] if base and base["key"] == self.key else self.buckets
        whole = base is None or base["key"] != self.key or buckets == 1 or any(p.startswith("+") for p in base["parts"])
        if whole:
            rows = changes if base is None else self._flagged(self._rows(base), changes)
            self.write(self._last(rows, order, self.buckets, base is None), version, token)
            return
        changes = changes.withColumn(PART, self._bucket(buckets)).persist()
        try:
            touched = {str(r[PART]) for r in changes.select(PART).distinct().collect()}
            old = self._rows(base, touched).withColumn(PART, self._bucket(buckets))
            schema = _grown(T.StructType.fromJson(base["schema"]), changes.drop(PART).schema)
            if touched:
                self._write_parts(self._last(self._flagged(old, changes), order, buckets, False), version)
            parts = {**base["parts"], **{p: f"v={version}/{PART}={p}" for p in touched}}
        finally:
            changes.unpersist()
        self.buckets = buckets
        self._publish(version, self._content(parts, schema), token)

    def vacuum(self) -> None:
        """Deletes what neither the present version nor the one before it is made of."""
        at = self._pointer()
        kept = {v: self.content(v) for v in (at.get("version"), at.get("previous")) if v is not None}
        folders = {f for content in kept.values() for f in content["parts"].values()}
        for v in self._numbers("", "v="):
            if f"v={v}" in folders:
                continue
            written = {f"v={v}/{PART}={p}" for p in self._numbers(f"v={v}", f"{PART}=")}
            if not written & folders:
                delete(self.spark, f"{self.path}/v={v}")
            for f in written - folders:
                delete(self.spark, f"{self.path}/{f}")
        for v in self._numbers("versions", ""):
            if v not in kept:
                delete(self.spark, f"{self.path}/versions/{v}.json")

    def _numbers(self, folder: str, start: str) -> list[int]:
        """The numbers of what stands in a folder under names with that start."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        names = [f.getPath().getName().removesuffix(".json") for f in at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at)]
        return sorted(int(n[len(start) :]) for n in names if n.startswith(start) and n[len(start) :].isdigit())

    @staticmethod
    def _flagged(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)

    def _last(self, rows: DataFrame, order: Column | None, buckets: int, plain: bool) -> DataFrame:
        """The last row of each key. Rows are moved once, by part, so that each part is one task's."""
        if plain and order is None:
            return rows
        dealt = PART in rows.columns
        if dealt:
            rows = rows.repartition(buckets, PART)
        by = Window.partitionBy(*([PART] if dealt else []), *[F.col(f"`{k}`") for k in self.key])
        ordered = [order.desc()] if order is not None else [F.col("_new").desc()]
        return rows.withColumn("_nth", F.row_number().over(by.orderBy(*ordered))).where("_nth = 1").drop("_nth", "_new")


def _grown(schema: T.StructType, more: T.StructType) -> T.StructType:
    """The fields of a schema, then those of another that it doesn't have."""
    have = {f.name.lower() for f in schema}
    return T.StructType([*schema.fields, *[f for f in more.fields if f.name.lower() not in have]])
