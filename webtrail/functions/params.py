"""Key/value parameter arrays: typed-value coalesce, widening to columns, JSON parsing.

A parameter array is ``ARRAY<STRUCT<key, value: STRUCT<string_value, int_value,
double_value, float_value>>>``.  Widening keys to columns is a pure expression over
the array, so the "pivot with max on duplicate keys" needs no explode and no shuffle:
each event row stays where it is.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtrail.schema import PARAMS_DDL

VALUE_FIELDS = ("string_value", "int_value", "double_value", "float_value")

PARAM_VALUE_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in VALUE_FIELDS])
PARAM_TYPE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE_TYPE)])
PARAMS_TYPE = T.ArrayType(PARAM_TYPE)


def param_value(p: Column, trim: bool = False) -> Column:
    """First non-null typed value of one parameter element, as a string.

    Order: string, int, double, float.  ``trim`` trims the chosen value.
    """
    v = p["value"]
    out = F.coalesce(*[v[f].cast("string") for f in VALUE_FIELDS])
    return F.trim(out) if trim else out


def param(params: Column | str, key: str, trim_values: bool = False) -> Column:
    """Value of ``key`` in a parameter array; the string max when the key repeats.

    Null when the key is absent or all its values are null.  ``trim_values``
    trims each value *before* taking the max; otherwise trim the result after.
    """
    arr = F.col(params) if isinstance(params, str) else params
    hits = F.filter(arr, lambda p: p["key"] == F.lit(key))
    return F.array_max(F.transform(hits, lambda p: param_value(p, trim_values)))


def has_params(params: Column | str) -> Column:
    """True when the array has at least one element (inner-unnest keeps the row)."""
    arr = F.col(params) if isinstance(params, str) else params
    return F.size(arr) > 0


def widen_params(df: DataFrame, params: str, keys: Iterable[str], prefix: str = "__p_") -> DataFrame:
    """Add one column per key (``prefix + key``), each as :func:`param` gives it.

    The array is read once: it becomes a map of key to value, and a key is looked up in
    generated code.  Only an array that repeats a key is sorted, so that each key's last value is its
    maximum.  For a few keys :func:`param` is faster."""
    pairs, keys_col, repeats = "__pairs", F.col("__pairs")["key"], F.col("__repeats")
    entry = lambda p: F.struct(F.coalesce(p["key"], F.lit("")).alias("key"),
                               F.when(p["key"].isNotNull(), param_value(p)).alias("value"))
    out = df.withColumn(pairs, F.transform(params, entry))
    out = out.withColumn("__repeats", F.size(F.array_distinct(keys_col)) < F.size(pairs))
    out = out.withColumn(pairs, F.when(repeats, F.array_sort(pairs)).otherwise(F.col(pairs)))
    last = F.filter(pairs, lambda p, i: ~F.coalesce(F.get(F.col(pairs), i + 1)["key"] == p["key"], F.lit(False)))
    out = out.withColumn("__map", F.map_from_entries(F.when(repeats, last).otherwise(F.col(pairs))))
    return out.withColumns({prefix + k: F.try_element_at("__map", F.lit(k)) for k in keys}).drop(
        pairs, "__repeats", "__map")


def explode_params(df: DataFrame, params: str, key_col: str = "param_key", value_col: str = "param_value",
                   trim_values: bool = False) -> DataFrame:
    """One row per (row, parameter); rows with null or empty arrays vanish (inner unnest)."""
    p = F.explode(params).alias("_p")
    out = df.select("*", p)
    return out.withColumns({key_col: F.col("_p")["key"],
                            value_col: param_value(F.col("_p"), trim_values)}).drop("_p")


def parse_params_json(text: Column | str) -> Column:
    """Parse a JSON text array of parameters; all four value fields are read as strings,
    so integers keep their digits."""
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c, PARAMS_DDL)
