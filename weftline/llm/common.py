"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One or more characters that are no ASCII white space make a word; this class separates words.
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of a key that one task may take in a join, and the share of all rows from which a key counts as hot.  At most
#: HOT_SHARE keys can be hot, so their list is always small.
HOT_ROWS, HOT_SHARE = 2_000, 4_096

_LOCAL: list[str] = []
_RECORDS: list[list[DataFrame]] = []


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table of a data folder, pruned to columns if any are given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a temporary one only where that is unset on a local master."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: executors on several machines need a folder that they share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="weftline-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._weftline_path = path
    for made in _RECORDS:
        made.append(back)
    return back


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that materialize writes meanwhile, so that they can be discarded once their results are written."""
    made: list[DataFrame] = []
    _RECORDS.append(made)
    try:
        yield made
    finally:
        _RECORDS.remove(made)


def discard(*tables: DataFrame) -> None:
    """Delete what materialize wrote for tables that nothing will read again, and let Spark drop the shuffles behind them."""
    for df in tables:
        path = getattr(df, "_weftline_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()  # the context cleaner removes shuffle files of plans that are gone


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """The hot keys of df with the number of parts to deal them over (column parts); None if there are none."""
    return hot_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")), keys)


def hot_counts(counts: DataFrame, keys: list[str]) -> DataFrame | None:
    """The same from a table that has the rows of each key as c."""
    total = counts.agg(F.sum("c")).first()[0] or 0
    parts = F.ceil(F.col("c") / HOT_ROWS).cast("int").alias("parts")
    found = counts.where(F.col("c") > max(HOT_ROWS, total // HOT_SHARE)).select(*keys, parts)
    rows = found.collect()  # HOT_SHARE at most
    return counts.sparkSession.createDataFrame(rows, found.schema) if rows else None


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], by: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """left joined with right (few rows a key), the hot keys of left dealt over several tasks by a hash of column `by`."""
    if hot is None:
        return left.join(right, keys, how)
    deal = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(by), F.col("parts")).cast("int"))
    salted = left.join(F.broadcast(hot), keys, "left").withColumn("_salt", deal).drop("parts")
    spread = right.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))).drop("parts")
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def words(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once per row, whatever the number of its uses inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
