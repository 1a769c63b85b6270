"""File system access of the driver (existence, rename, create-if-absent) and
a listing of files as a table, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

LISTING = StructType([StructField("path", StringType()), StructField("length", LongType()), StructField("modified", TimestampType())])


def hadoop(spark: SparkSession, path: str):
    """(file system, path object) of a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop(spark, path)
    return fs.exists(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a new name; its parent is made if there is none."""
    fs, src = hadoop(spark, source)
    _, dst = hadoop(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise FileExistsError(f"{source} could not become {target}")


def create_if_absent(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with ``text``; False if there is one already. Of several
    writers one gets True."""
    fs, target = hadoop(spark, path)
    fs.mkdirs(target.getParent())
    try:
        out = fs.create(target, False)
    except Exception as error:
        if exists(spark, path):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def listing(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modified) of the files below a folder; no file is opened,
    as the column with the content isn't read. Files without a byte are not
    listed. A missing folder has no files."""
    if not exists(spark, path):
        return spark.createDataFrame([], LISTING)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return files.select(F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"))
