"""One-hot columns of any number of levels: a stored level table, joined ids, sparse vectors.

Levels never reach the driver and never become columns of a plan. They are numbered from 0 in ascending order of their text
by a sort over ranges: each range is numbered by itself and starts after the sizes of those before it. Rows get
their level's id by a join (a hot level is split by the adaptive join); a null level or one the table does not have gets no entry.
"""

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F


def fit_levels(df, column, path, min_rows=1):
    """Write the level table (level, level_id, rows) of a column to ``path`` and read it back."""
    spark = df.sparkSession
    level = F.col(column).cast("string").alias("level")
    counted = df.select(level).where("level is not null").groupBy("level").agg(F.count("*").alias("rows"))
    ranges = counted.where(F.col("rows") >= min_rows).repartitionByRange("level")
    # the range a level fell into is stored, because a second sort may cut the ranges elsewhere
    ranges.withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/ranges")
    placed = spark.read.parquet(f"{path}/ranges")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("level")) - 1
    numbered = placed.withColumn("place", inside).join(starts, "part")
    numbered.select("level", (F.col("start") + F.col("place")).alias("level_id"), "rows").write.parquet(f"{path}/levels")
    return load_levels(spark, path)


def load_levels(spark, path):
    return spark.read.schema("level string, level_id long, rows long").parquet(f"{path}/levels")


def with_level_id(df, column, levels, name="level_id"):
    """Add the id of each row's level; null if it has none. Rows without a level do not meet in one task."""
    ids = levels.select(F.col("level").alias("_level"), F.col("level_id").alias(name))
    text = F.col(column).cast("string")
    known = df.where(text.isNotNull()).join(ids, text == F.col("_level"), "left").drop("_level")
    return known.unionByName(df.where(text.isNull()).withColumn(name, F.lit(None).cast("long")))


def one_hot(df, size, id_column="level_id", name="level_vector"):
    """Sparse vector of ``size`` entries with a 1 at the row's id; without an id it has no entry.

    The id ``size`` stands for "none", and the encoder leaves its last category out.
    """
    spark = df.sparkSession
    rows = df.withColumn("_id", F.coalesce(F.col(id_column), F.lit(size)).cast("double"))
    encoder = OneHotEncoder(inputCol="_id", outputCol=name, dropLast=True)
    sized = encoder.fit(spark.createDataFrame([(float(size),)], "_id double"))
    return sized.transform(rows).drop("_id")


def sparse_features(df, columns, column, levels, name="features"):
    """Numeric ``columns`` and the one-hot of ``column`` as one sparse vector."""
    size = levels.count()
    encoded = one_hot(with_level_id(df, column, levels), size)
    assembler = VectorAssembler(inputCols=[*columns, "level_vector"], outputCol=name)
    return assembler.transform(encoded)
