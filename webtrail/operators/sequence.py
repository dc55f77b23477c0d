"""A global ``row_number() over (order by ...)`` without a single-task window.

An unpartitioned window moves every row into one task.  Instead:

1. range-partition the batch on the full sort key (sampled bounds, so even a
   timestamp shared by a third of all rows is split by the tie-break columns),
   and sort within each partition; the number of ranges follows the input's size;
2. number rows inside each partition (``monotonically_increasing_id`` minus the
   partition's base, which is ``partition_id << 33``);
3. stage the rows with partition id and local number as Parquet in the shared folder;
4. count the rows of each partition that was *written*, from the staged id column alone (a
   constant per file, so a few bytes of it), and store running offsets - one row a partition,
   bounded by the number of tasks, not by the data.  Nothing relies on the number of ranges
   asked for: Spark may have run the stage with more or fewer;
5. join each row's partition with its offset (a broadcast of 16 bytes a task).

Range bounds are sampled from the input, so two evaluations of step 1 can disagree when
the upstream partitioning differs.  The ids are therefore stored values: every branch
reads the same ones, the lineage is cut, and a lost executor cannot renumber rows.  As
the stage is columnar, each table built from it reads only its own columns.  The result
equals the global row_number for any total order.

Inside :func:`staging` everything is staged in a folder that goes at its end.
"""

from __future__ import annotations

import contextlib
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtrail.session import shared_dir

_PID = "__seq_pid"
_LOCAL = "__seq_local"
_OFFSET = "__seq_offset"
#: Bytes of input (as Spark knows them from its files) a range is meant to hold, and the most ranges.
RANGE_BYTES, MAX_RANGES = 128 << 20, 50_000


def _num_ranges(df: DataFrame) -> int:
    """As many ranges as the size of what the batch is read from asks for; at least a task for each
    core.  Inputs of unknown size (rows that a program holds) count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < 1 << 60)
    return max(df.sparkSession.sparkContext.defaultParallelism, min(MAX_RANGES, -(-size // RANGE_BYTES)))


_FOLDERS: list[str] = []


def staged_folder(spark: SparkSession) -> str:
    """Where batches are staged now: the folder of the run in progress, else the application's."""
    return _FOLDERS[-1] if _FOLDERS else shared_dir(spark, "webtrail-staged", spark.sparkContext.applicationId)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """A folder of its own for what is staged inside, deleted at the end: frames built on it can
    no longer be read then, so write the tables first."""
    folder = shared_dir(spark, "webtrail-staged", uuid.uuid4().hex)
    _FOLDERS.append(folder)
    try:
        yield folder
    finally:
        _FOLDERS.remove(folder)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of the run in progress and read back."""
    spark, path = df.sparkSession, f"{staged_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def global_sequence(df: DataFrame, order_by: Sequence[Column], out: str = "s_no",
                    num_partitions: int | None = None) -> DataFrame:
    """Append ``out`` = 1-based position of each row in ``order_by`` order.

    ``order_by`` must be a total order for a deterministic result (add a
    tie-break column); ties get distinct, arbitrary numbers otherwise.
    """
    ranged = df.repartitionByRange(num_partitions or _num_ranges(df), *order_by).sortWithinPartitions(*order_by)
    local = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(
        _LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    rows = staged(local)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(_PID).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(_PID, F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias(_OFFSET))
    return (rows.join(F.broadcast(staged(offsets)), _PID)
            .withColumn(out, F.col(_OFFSET) + F.col(_LOCAL) + F.lit(1)).drop(_PID, _LOCAL, _OFFSET))
