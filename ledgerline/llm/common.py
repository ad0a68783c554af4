"""What several operators share: reading tables, storing intermediate tables, the word pattern."""

import gc
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_dir

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Rows in a batch of texts on its way to Python: a thousandth of a split or so, and small even if texts are long.
BATCH_ROWS = 256


def bound_batches(spark: SparkSession) -> None:
    """Workers hold one batch at a time; the default of 10,000 rows may be gigabytes of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


@contextmanager
def slim_batches(spark: SparkSession):
    """For jobs without texts: batches of 10,000 rows, since small ones cost more than their rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 10_000)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def collected(spark: SparkSession) -> None:
    """Shuffle files that nothing reads any more go when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def n_words(text):
    """Words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest_of_words(text):
    """Hash of a text's lower-cased words: equal for copies that differ in case and spacing only."""
    return F.xxhash64(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BLANK, " "))
