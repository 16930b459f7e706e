"""Amended rows into a stored table: the latest row of each key, touched partitions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written


def latest(rows: DataFrame, keys: Sequence[str], version: str | Column | Sequence[str]) -> DataFrame:
    """One row per key, that of the highest version (of several columns the first counts most); of equal
    ones the largest row.

    Rows that lack a part of their key cannot be told apart and all stay. An aggregate with
    partial results, so many rows of one key meet no window and no single task. Keys that are
    the same in all rows of a group, and versions that are columns, are shuffled once only.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    own = {k for k in keys if _same_if_equal(rows.schema[k].dataType)}
    versions = [version] if isinstance(version, (str, Column)) else list(version)
    # Names of ours, since a column may be called like the key beside which it stands.
    ahead = {f"v{i}": F.col(v) if isinstance(v, str) else v for i, v in enumerate(versions)}
    places = {v: F.col("_m")[f"v{i}"] for i, v in enumerate(versions) if isinstance(v, str) and v in rows.columns}
    rest = [c for c in rows.columns if c not in own and c not in places]
    places |= {c: F.col("_m")[f"c{i}"] for i, c in enumerate(rest)}
    row = F.struct(*[c.alias(n) for n, c in ahead.items()], *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    one = (rows.where(known).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
           .agg(F.max(row).alias("_m")))
    places |= {k: F.col(f"_k{i}") for i, k in enumerate(keys) if k in own}
    return one.select(*[places[c].alias(c) for c in rows.columns]).unionByName(rows.where(~known))


def _same_if_equal(kind: T.DataType) -> bool:
    """Whether equal values are the same to the last bit: not so for 0.0 and -0.0, or under a collation."""
    return kind == T.StringType() or isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType, T.BooleanType,
                                                       T.TimestampType, T.TimestampNTZType))


def _among(column: str, values: Sequence) -> Column:
    given = [v for v in values if v is not None]
    found = F.col(column).isin(*given) if given else F.lit(False)
    return found | F.col(column).isNull() if len(given) < len(values) else F.coalesce(found, F.lit(False))


def upsert(path: str, changes: DataFrame, keys: Sequence[str], version: str, partition_by: str, *,
           deleted: str | None = None) -> list:
    """Put `changes` into the parquet table at `path`; the partitions written are returned.

    The stored row of a key gives way to a change of at least its version, wherever either is
    stored: a row whose partition changes leaves the old one. Older changes have no effect. `deleted`
    names a boolean column of `changes`; a row that is true there takes its key out. Columns of the
    table that `changes` lacks become NULL.

    Of the stored table, keys are read once in the partitions that no change goes to, and whole rows
    in the touched partitions only; all other files stay as they are. The driver sees partition values. Everything
    is staged in the shared folder before the table is changed, and running the same changes again
    repairs a run that was cut off.
    """
    spark = changes.sparkSession
    stored = spark.read.parquet(path)
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    wanted = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in changes.columns
              else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields]
    newest = written(latest(changes.select(*wanted, gone.alias("_gone")), keys, version), "changes")
    touched = [r[0] for r in newest.where("not _gone").select(partition_by).distinct().collect()]
    # Rows that leave are looked for in the other partitions; those touched are read whole anyway.
    other = stored.where(~_among(partition_by, touched))
    if not other.isEmpty():
        homes = other.select(*keys, partition_by).join(newest.select(*keys), list(keys), "left_semi")
        touched += [r[0] for r in homes.select(partition_by).distinct().collect()]
    if not touched:
        return []
    old = stored.where(_among(partition_by, touched))
    both = old.select("*", F.lit(False).alias("_gone"), F.lit(0).alias("_change")).unionByName(
        newest.withColumn("_change", F.lit(1)))
    staged = written(latest(both, keys, [version, "_change"]).where("not _gone")
                     .drop("_gone", "_change"), "upserted")
    filled = {r[0] for r in staged.select(partition_by).distinct().collect()}
    emptied = [p for p in touched if p not in filled]
    files = [r[0] for r in old.where(_among(partition_by, emptied)).select("_metadata.file_path")
             .distinct().collect()] if emptied else []
    (staged.select(stored.columns).hint("rebalance", partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        where.getFileSystem(conf).delete(where, False)
    return sorted(touched, key=lambda v: (v is not None, v))
