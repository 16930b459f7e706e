"""Writing tables, views and exports."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from types import MappingProxyType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter

from ..session import scratch_path

BLOCK_BYTES = 64 << 20  # of a joined file, which one task fills
COPY_BYTES = 1 << 20    # read in one go


def write_table(
    df: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Create or replace a parquet table; mode="ignore" keeps what is already there.

    With `partition_by`, rows of one partition value are brought together before the write by a
    rebalance, which adaptive execution splits where one value holds much of the data. So a year
    with most of the rows becomes many files of even size, and a thin year one file.

    With `bucket_by` a table (a name, and a path if it is to lie there) is dealt into `buckets` files by
    those columns and sorted by them. Tables with the same buckets join on these columns without a
    shuffle. The rows are shuffled once here, so that each bucket is one file; choose the number so that a
    bucket fits a task.
    """
    if bucket_by:
        if not table or not buckets or partition_by:
            raise ValueError("a bucketed table needs a name and a number of buckets, and no partitions")
        writer = (df.repartition(buckets, *bucket_by).write.mode(mode).format("parquet")
                  .bucketBy(buckets, *bucket_by).sortBy(*bucket_by))
        (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def export_csv(
    df: DataFrame,
    path: str,
    *,
    single_file: bool = False,
    order_by: Sequence[str | Column] = (),
    mode: str = "overwrite",
) -> None:
    """Write CSV with a header, by default in as many files as there are tasks.

    `single_file` gathers all rows in one task, which writes them; earlier work stays spread out
    (which `coalesce(1)` would not do). Meant for results, not for tables of any size. Gathering
    keeps no order, so give `order_by` where the file is to have one.
    """
    if single_file:
        df = df.repartition(1)
        if order_by:
            df = df.sortWithinPartitions(*order_by)
    elif order_by:
        df = df.orderBy(*order_by)
    _csv(df.write.mode(mode), True).csv(path)


def _csv(writer: DataFrameWriter, header: bool) -> DataFrameWriter:
    return (writer.option("header", header).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def export_one_csv(df: DataFrame, path: str, *, order_by: Sequence[str | Column] = ()) -> None:
    """Write CSV with a header as one file in the new folder `path`, for tables of any size.

    All tasks write parts to the shared scratch folder. Their lengths say where each lies in the one
    file, whose blocks are then filled side by side, each by one task. A task that runs again
    puts the same bytes in the same place, and the file gets its name at the end.

    That needs files which can be written anywhere: the local file system, or a shared one that is
    mounted. On others (HDFS, object stores) a file has one writer, and so one task writes it, as
    `export_csv` with `single_file` does.
    """
    spark = df.sparkSession
    new_path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    parts = scratch_path(spark, "csv-parts")
    folder, scratch = new_path(path), new_path(parts)
    fs = folder.getFileSystem(conf)
    if fs.exists(folder):
        raise FileExistsError(path)
    if {fs.getUri().getScheme(), scratch.getFileSystem(conf).getUri().getScheme()} != {"file"}:
        return export_csv(df, path, single_file=True, order_by=order_by, mode="error")
    _csv(df.limit(0).coalesce(1).write, True).csv(f"{parts}/head")
    _csv((df.orderBy(*order_by) if order_by else df).write, False).csv(f"{parts}/rows")
    files = [(r.path.removeprefix("file:"), r.length) for part in ("head", "rows") for r in sorted(
        spark.read.format("binaryFile").load(f"{parts}/{part}").select("path", "length").collect(),
        key=lambda r: (len(r.path), r.path))]
    name = f"part-00000-{uuid.uuid4()}.csv"
    made = new_path(folder, f"_{name}")
    fs.mkdirs(folder)
    target = fs.makeQualified(made).toUri().getPath()

    def fill(batches):
        for b in batches:
            for place, pieces in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with open(os.open(target, os.O_CREAT | os.O_WRONLY, 0o644), "wb") as out:
                    out.seek(place)
                    for piece in pieces:
                        _copy(piece["file"], piece["start"], piece["size"], out)
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64())], ["place"])

    blocks = _blocks(files, BLOCK_BYTES)
    (spark.createDataFrame(blocks, "place long, pieces array<struct<file: string, start: long, size: long>>")
     .repartition(len(blocks)).mapInArrow(fill, "place long").write.format("noop").mode("overwrite").save())
    if fs.getFileStatus(made).getLen() != sum(length for _, length in files) or not fs.rename(
            made, new_path(folder, name)):
        raise OSError(f"{target} is not whole")
    scratch.getFileSystem(conf).delete(scratch, True)


def _blocks(files: list[tuple[str, int]], size: int) -> list[tuple[int, list[tuple[str, int, int]]]]:
    """(place, pieces) of each `size` bytes of what `files`, (name, length), are one after the other; a
    piece is (name, start, length)."""
    out: list[tuple[int, list]] = []
    place = 0
    for name, length in files:
        start = 0
        while start < length:
            if place % size == 0:
                out.append((place, []))
            n = min(length - start, size - place % size)
            out[-1][1].append((name, start, n))
            place, start = place + n, start + n
    return out


def _copy(name: str, start: int, size: int, out) -> None:
    with open(name, "rb") as f:
        f.seek(start)
        while size:
            data = f.read(min(size, COPY_BYTES))
            if not data:
                raise EOFError(f"{name} has become shorter")
            out.write(data)
            size -= len(data)


def export_all(
    views: Mapping[str, DataFrame], folder: str, *, single_file: bool = False,
    orders: Mapping[str, Sequence[str | Column]] = MappingProxyType({}),
) -> dict[str, str]:
    """Export each named result below `folder`, in its order if `orders` has one; name -> path."""
    paths = {}
    for name, df in views.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        export_csv(df, paths[name], single_file=single_file, order_by=orders.get(name, ()))
    return paths
