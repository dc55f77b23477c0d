import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    from webtrail.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="webtrail-tests")
    yield s


EPOCH = dt.datetime(1970, 1, 1)


def micros(ts: str) -> int:
    """UTC wall clock 'YYYY-MM-DD HH:MM:SS[.ffffff]' -> epoch microseconds."""
    d = dt.datetime.fromisoformat(ts)
    return (d - EPOCH) // dt.timedelta(microseconds=1)


def p(key, string=None, int_=None, double=None, float_=None):
    return {"key": key, "value": {"string_value": string, "int_value": int_, "double_value": double,
                                  "float_value": float_}}


def raw(spark, rows):
    """Raw feed frame from dicts; missing columns are null, ``ts`` is a UTC string."""
    from webtrail.schema import RAW_EVENT_DDL
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(RAW_EVENT_DDL)
    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        if "ts" in r:
            t = r.pop("ts")
            r["event_timestamp"] = micros(t)
            r.setdefault("event_date", dt.date.fromisoformat(t[:10]))
        r.setdefault("event_bundle_sequence_id", i)
        r.setdefault("event_params", [p("ga_session_id", int_="1")])
        r.setdefault("items", [])
        out.append(tuple(r.get(f.name) for f in schema.fields))
    return spark.createDataFrame(out, schema)


def frame(spark, ddl, rows):
    return spark.createDataFrame(rows, ddl)
