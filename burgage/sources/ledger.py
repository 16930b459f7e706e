"""A ledger of landed files: what a file holds is loaded once, whatever its name.

The ledger is a small parquet table with a row per file and run: path, content digest, size, and
what was done. A landing folder is compared with it by content, so that a file which comes again, under
its name or another, is passed over, and one whose content changed takes the place of the old one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

LEDGER = "run long, path string, digest string, length long, state string"
LOADED, DUPLICATE, SAME, REPLACED = "loaded", "duplicate", "same", "replaced"


def digests(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, digest, length) of the files below a folder; each is read whole by one task."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("_metadata.file_path").alias("path"),
                                    F.sha2("content", 256).alias("digest"), "length")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries; none where the ledger is not there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def standing(entries: DataFrame) -> DataFrame:
    """(path, digest, length, state): the last entry of each path that says what it holds."""
    last = F.max_by(F.struct("digest", "length", "state"), "run").alias("last")
    return entries.where(F.col("state") != REPLACED).groupBy("path").agg(last).select("path", "last.*")


def compared(landed: DataFrame, entries: DataFrame) -> DataFrame:
    """(path, digest, length, state) of landed files, and of files of the ledger that were replaced.

    `loaded`: the content is new, and this is the first path of it. `duplicate`: another path holds
    it. `same`: this path held it before. `replaced`: the content that a path held before it changed, if no
    other path of the ledger holds it; its rows should go.
    """
    before = standing(entries).select("path", F.col("digest").alias("old"))
    # Content may be loaded, replaced and loaded again; the last of these counts.
    known = (entries.where(F.col("state").isin(LOADED, REPLACED)).groupBy("digest")
             .agg(F.max_by("state", "run").alias("last")).where(F.col("last") == LOADED)
             .select("digest", F.lit(True).alias("known")))
    first = landed.groupBy("digest").agg(F.min("path").alias("path")).withColumn("first", F.lit(True))
    now = (landed.join(first, ["digest", "path"], "left").join(before, "path", "left")
           .join(known, "digest", "left"))
    state = (F.when(F.col("old") == F.col("digest"), F.lit(SAME))
             .when(F.col("known").isNotNull() | F.col("first").isNull(), F.lit(DUPLICATE))
             .otherwise(F.lit(LOADED)))
    now = now.select("path", "digest", "length", "old", state.alias("state"))
    changed = now.where(F.col("old").isNotNull() & (F.col("old") != F.col("digest")))
    # Content that some path still holds: untouched ledger paths, and what has just landed.
    holding = (before.join(changed.select("path"), "path", "left_anti").select(F.col("old").alias("digest"))
               .union(now.select("digest")).distinct())
    gone = (changed.select("path", F.col("old").alias("digest"), F.lit(0).cast("long").alias("length"),
                           F.lit(REPLACED).alias("state"))
            .join(holding, "digest", "left_anti").dropDuplicates(["digest"])
            .select("path", "digest", "length", "state"))
    return now.drop("old").select("path", "digest", "length", "state").unionByName(gone)


def settle(spark: SparkSession, path: str, ledger: str, pattern: str | None = None) -> DataFrame:
    """Compare a landing folder with the ledger, write what was found to it, and return that.

    Entries of one run are written together, so a run that fails leaves the ledger as it was. Load
    the files that are `loaded` and take out the rows of digests that are `replaced` before the next run.
    """
    entries = read_ledger(spark, ledger)
    run = entries.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
    found = written(compared(digests(spark, path, pattern), entries), "ledger")
    (found.where(F.col("state") != SAME)
     .select(F.lit(run).cast("long").alias("run"), "path", "digest", "length", "state")
     .coalesce(1).write.mode("append").parquet(ledger))
    return found
