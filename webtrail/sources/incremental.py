"""Day-keyed incremental tables (I1-I6, S5, S6) on Parquet in shared storage.

A target is a Parquet directory partitioned by ``event_date``, with its schema stored beside
the data (``_schema/<version>.json``, which Parquet readers skip).  A daily run:

1. drops the newest stored day, if the table holds data (I2) - even when the feed
   has no rows for that day, which an overwrite alone would not do;
2. reads the high-water mark **after** the drop (I1; no stored day -> 1900-01-01);
3. builds every day past the mark from the feed (I3) - the mark is one collected
   date, so the feed scan gets a static partition filter;
4. syncs the stored schema to the new one (I5) - a new schema version, no data file
   is touched: files that lack a column read as null, a dropped column is not read;
5. writes with dynamic partition overwrite, so a re-run replaces exactly the
   days it produced and leaves the others alone (I4, idempotent).

A table without any stored day (one day that was dropped, or a batch without rows) is
an empty table with its schema, not a missing one.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtrail.session import shared_dir

DATE_COL = "event_date"
NO_MARK = dt.date(1900, 1, 1)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """Does the target hold data files?"""
    return bool(stored_days(spark, path))


def _schema_versions(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, f"{path.rstrip('/')}/_schema")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n for n in names if n.endswith(".json"))


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's schema: its newest stored version, or the data files' own without one."""
    versions = _schema_versions(spark, path)
    if versions:
        text = spark.read.text(f"{path.rstrip('/')}/_schema/{versions[-1]}", wholetext=True).first()[0]
        return T.StructType.fromJson(json.loads(text))
    return spark.read.parquet(path).schema if table_exists(spark, path) else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table under its stored schema; empty if it holds no data."""
    schema = stored_schema(spark, path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def high_water_mark_df(table: DataFrame) -> DataFrame:
    """One-row frame: newest stored day, 1900-01-01 for an empty table."""
    return table.agg(F.coalesce(F.max(DATE_COL), F.lit(NO_MARK)).alias("high_water_mark"))


def _is_data_file(name: str) -> bool:
    return not (name.startswith("_") or name.startswith("."))


def stored_days(spark: SparkSession, path: str, nested: bool = False) -> list[dt.date]:
    """Days that hold data files, from the partition directory listing (no data read); ``nested``: days
    that hold further partitions."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    days = []
    prefix = f"{DATE_COL}="
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if any(_is_data_file(f.getPath().getName()) and f.isDirectory() == nested for f in fs.listStatus(st.getPath())):
                days.append(dt.date.fromisoformat(name[len(prefix):]))
    return sorted(days)


def high_water_mark(spark: SparkSession, path: str) -> dt.date:
    """Newest stored day of the target; 1900-01-01 when it does not exist.

    Read from the ``event_date=`` directory names, so the cost grows with the
    number of days, not with the size of the table."""
    days = stored_days(spark, path)
    return days[-1] if days else NO_MARK


def drop_latest_day(spark: SparkSession, path: str) -> dt.date | None:
    """Delete the newest day's partition; returns the dropped day."""
    day = high_water_mark(spark, path)
    if day == NO_MARK:
        return None
    drop_days(spark, path, [day])
    return day


_INTEGERS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def readable_as(stored: T.DataType, target: T.DataType) -> bool:
    """Whether Spark's Parquet reader gives ``target`` from files that hold ``stored``: the same type or one
    that holds all its values.  Narrower types, and text for numbers, fail only when old files are read."""
    if isinstance(stored, T.ArrayType) and isinstance(target, T.ArrayType):
        return readable_as(stored.elementType, target.elementType)
    if isinstance(stored, T.MapType) and isinstance(target, T.MapType):
        return readable_as(stored.keyType, target.keyType) and readable_as(stored.valueType, target.valueType)
    if isinstance(stored, T.StructType) and isinstance(target, T.StructType):
        fields = {f.name: f.dataType for f in stored.fields}
        return all(readable_as(fields[f.name], f.dataType) for f in target.fields if f.name in fields)
    if stored in _INTEGERS:
        digits = _INTEGERS[stored]
        if target in _INTEGERS:
            return _INTEGERS[target] >= digits
        if isinstance(target, T.DecimalType):
            return target.precision - target.scale >= max(digits, 10)
        return target == T.DoubleType() and digits <= 10
    if isinstance(stored, T.DecimalType) and isinstance(target, T.DecimalType):
        more = target.scale - stored.scale
        return more >= 0 and target.precision - stored.precision >= more
    wider = {T.FloatType(): T.DoubleType(), T.DateType(): T.TimestampNTZType()}
    return stored == target or wider.get(stored) == target


def _check_types(spark: SparkSession, path: str, target: T.StructType) -> None:
    """Refuse a target whose column some stored version holds in a type that cannot be read as the new one
    (a column that was dropped for a while may still be in old files)."""
    if not table_exists(spark, path):
        return
    base = f"{path.rstrip('/')}/_schema"
    held = [T.StructType.fromJson(json.loads(read_text(spark, f"{base}/{v}"))) for v in _schema_versions(spark, path)]
    wanted = {f.name: f.dataType for f in target.fields}
    for schema in held or [stored_schema(spark, path)]:
        for f in schema.fields:
            if f.name in wanted and not readable_as(f.dataType, wanted[f.name]):
                raise TypeError(f"{path} holds column {f.name} as {f.dataType.simpleString()}, which cannot be read as "
                                f"{wanted[f.name].simpleString()}; rewrite the table first")


def sync_schema(spark: SparkSession, path: str, target: T.StructType) -> bool:
    """Make the stored table carry exactly ``target``'s columns (new ones null).

    Writes a new schema version if it differs from the stored one and returns whether it
    did.  A column keeps its type or gets a wider one that Parquet readers convert to; any
    other change is refused before the version is written.
    The version appears by one rename, so a run that stops before it leaves the old
    schema and one that stops after it the new one, with all data in either case."""
    stored = stored_schema(spark, path)
    shape = lambda schema: {f.name: f.dataType for f in schema.fields}
    versions = _schema_versions(spark, path)
    if versions and stored is not None and shape(stored) == shape(target):
        return False
    _check_types(spark, path, target)
    base = f"{path.rstrip('/')}/_schema"
    fs, final = _fs(spark, f"{base}/{len(versions):06d}.json")
    _, temporary = _fs(spark, f"{base}/.{uuid.uuid4().hex}")
    out = fs.create(temporary)
    out.write(bytearray(json.dumps(T.StructType([T.StructField(f.name, f.dataType) for f in target.fields]).jsonValue())
                        .encode()))
    out.close()
    if not fs.rename(temporary, final):
        raise OSError(f"another run has just written {final}")
    return True


def write_days(df: DataFrame, path: str) -> None:
    """Dynamic partition overwrite keyed by day.  Rows are rebalanced by day first, so a
    day becomes a few files whatever the number of tasks, and AQE splits a large day."""
    (df.hint("rebalance", DATE_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DATE_COL).parquet(path))


def overwrite_table(df: DataFrame, path: str) -> None:
    """Full refresh (the intraday tables), laid out by day like the daily ones."""
    (df.hint("rebalance", DATE_COL).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(DATE_COL).parquet(path))
    sync_schema(df.sparkSession, path, df.schema)


def drop_days(spark: SparkSession, path: str, days: Iterable[dt.date]) -> None:
    for day in days:
        fs, p = _fs(spark, f"{path.rstrip('/')}/{DATE_COL}={day.isoformat()}")
        fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole; a stop in between leaves none."""
    fs, final = _fs(spark, path)
    _, temporary = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temporary)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(final, False)
    fs.rename(temporary, final)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    return spark.read.text(path, wholetext=True).first()[0] if fs.exists(p) else None


def run_daily(spark: SparkSession, feed: DataFrame, build: Callable[[DataFrame], DataFrame], path: str) -> dt.date:
    """One incremental run of a day-keyed table; returns the mark it built from."""
    drop_latest_day(spark, path)
    mark = high_water_mark(spark, path)
    out = build(feed.filter(F.col(DATE_COL) > F.lit(mark)))
    sync_schema(spark, path, out.schema)
    write_days(out, path)
    return mark


def scratch_target(spark: SparkSession, name: str) -> str:
    """A fresh table location in the shared checkpoint folder."""
    return shared_dir(spark, "webtrail-targets", f"{name}-{uuid.uuid4().hex[:12]}")
