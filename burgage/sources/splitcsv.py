"""Parallel reading of CSV files whose fields hold line breaks.

Spark's own multi-line reader takes a file as one task. Here every byte range of a file is a task.
Whether a line break ends a record depends on the quotes before it, which may lie in another range: a
break counts when an even number of quotes stands before it in the file. So

1. each range reports the parity of its quotes, the piece at its start that would belong to a record
   from before, and the piece at its end that would be left open, for both states it may start in;
2. a prefix sum of the parities over the ranges of a file says in which state each range does start,
   and pieces at the borders are put together to records;
3. each range is read again, with its state known, and gives out the records that lie inside it.

The second step sees a row per range. Records never move between tasks, but for those that cross a
border. Lines come from Spark's text reader, so any path and store that it reads will do, and a
file that cannot be split (a compressed one) is one range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NULL_TOKENS, as_strings
from ..session import written
from .csvfiles import null_tokens

_QUOTE, _LF, _CR = ord('"'), 10, 13
_BOM = "\ufeff"

# A quote opens a field only at its start, and is doubled inside.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",][^",]*+)?+'
_WELL_FORMED = rf"\A{_FIELD}(?:,{_FIELD})*+\z"


class _Lines(NamedTuple):
    """Consecutive lines of one range: bytes without breaks, offsets, quotes before each and after."""

    data: np.ndarray
    offsets: np.ndarray
    quotes: np.ndarray

    def text(self, first: int, last: int) -> bytes:
        """Lines first to last, last exclusive, with the breaks between them."""
        return b"\n".join(self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()
                          for i in range(first, last))

    def any_text(self, last: int) -> bool:
        """Whether any line before `last` is not empty."""
        return bool((self.data[:self.offsets[last]] != _CR).any())

    def returns(self) -> np.ndarray:
        """Whether each line ends with a carriage return."""
        full = np.diff(self.offsets) > 0
        full[full] = self.data[self.offsets[1:][full] - 1] == _CR
        return full

    def without_returns(self) -> _Lines:
        """The lines, those that end with a carriage return without it."""
        drop = self.returns()
        keep = np.ones(len(self.data), bool)
        keep[self.offsets[1:][drop] - 1] = False
        return _Lines(self.data[keep], self.offsets - np.concatenate([[0], np.cumsum(drop)]), self.quotes)


def _lines(column: pa.Array) -> _Lines:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    upto = np.concatenate([[0], np.cumsum(data == _QUOTE)])
    return _Lines(data, offsets, upto[offsets])


def _ranges(batches) -> Iterator[tuple[tuple[str, int], bool, _Lines]]:
    """((path, start of the range), whether it begins here, lines) in the order of the files."""
    before = None
    for b in batches:
        paths, starts = b.column(0).dictionary_encode(), b.column(1).to_numpy()
        codes = paths.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        edges = [0, *cuts.tolist(), b.num_rows]
        for low, high in zip(edges[:-1], edges[1:]):
            if low < high:
                key = paths.dictionary[int(codes[low])].as_py(), int(starts[low])
                yield key, key != before, _lines(b.column(2).slice(low, high - low))
                before = key


class _Border:
    """What one range has at its ends, if it starts inside quotes (1) or not (0)."""

    def __init__(self, key: tuple[str, int]):
        self.key, self.quotes = key, 0
        self.head: list[bytes] = []      # lines up to the first break that counts, if it starts inside
        self.head_ends = False
        self.tail: list[list[bytes]] = [[], []]  # lines since the last break that counts
        self.crlf = False                # whether the first line ends with a carriage return
        self.full = False                # whether a record that is not empty ends, if it starts outside

    def add(self, lines: _Lines) -> None:
        n = len(lines.offsets) - 1
        if not self.tail[0] and not self.tail[1] and not self.head:
            self.crlf = bool(lines.returns()[0])
        after = self.quotes + lines.quotes[1:]
        if not self.head_ends:
            odd = np.flatnonzero(after % 2 == 1)
            stop = int(odd[0]) + 1 if len(odd) else n
            self.head.append(lines.text(0, stop))
            self.head_ends = bool(len(odd))
        for state in (0, 1):
            ends = np.flatnonzero((after + state) % 2 == 0)
            first = int(ends[-1]) + 1 if len(ends) else 0
            if first:
                self.full |= state == 0 and bool(self.tail[0] or lines.any_text(first))
                self.tail[state] = []
            if first < n:
                self.tail[state].append(lines.text(first, n))
        self.quotes += int(lines.quotes[-1])

    def row(self) -> tuple:
        return (*self.key, self.quotes % 2, b"\n".join(self.head), self.head_ends,
                *(b"\n".join(t) for t in self.tail), self.full, self.crlf)


_BORDER = ("path string, start long, odd int, head binary, head_ends boolean, tail0 binary, tail1 binary, "
           "is_full boolean, crlf boolean")


def _borders(lines: DataFrame) -> DataFrame:
    def run(batches):
        border, rows = None, []
        for key, new, part in _ranges(batches):
            if new:
                rows += [border.row()] if border else []
                border = _Border(key)
            border.add(part)
        rows += [border.row()] if border else []
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.binary(), pa.binary(),
                 pa.bool_(), pa.bool_()]
        for row in rows:  # a piece may be long, so one row at a time
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)],
                                             [c.split()[0] for c in _BORDER.split(", ")])

    return lines.mapInArrow(run, _BORDER)


def _stitched(borders: DataFrame) -> DataFrame:
    """(path, record, first): records that cross a border, from the pieces at the ends of ranges.

    A range that is left open begins a record; ranges without a break that counts go on with it, and
    the first that has one ends it. `first` marks a file's first record.
    """
    in_file = W.partitionBy("path").orderBy("start")
    # 0 for a piece that goes on with a record from before, 1 for one that begins a record.
    pieces = borders.select(
        "path", "start", "crlf", F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("inside").cast("boolean").alias("there"),
                     F.col("head").alias("piece"), F.lit(False).alias("first")),
            F.struct(F.lit(1).alias("kind"),
                     (((F.col("inside") + F.col("odd")) % 2 == 1)
                      & ((F.col("inside") == 0) | F.col("head_ends"))).alias("there"),
                     F.when(F.col("inside") == 0, F.col("tail0")).otherwise(F.col("tail1")).alias("piece"),
                     ((F.col("start") == 0) & ~F.col("is_full")).alias("first")))).alias("p")
    ).select("path", "start", "crlf", "p.*").where("there")
    number = F.sum("kind").over(in_file.orderBy("start", "kind").rowsBetween(W.unboundedPreceding, 0))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", F.col("piece").cast("string").alias(
        "piece")))), lambda x: x["piece"])
    record = F.array_join(texts, "\n")
    return (pieces.withColumn("number", number).groupBy("path", "number")
            .agg(record.alias("record"), F.max("first").alias("first"), F.max("crlf").alias("crlf"))
            .select("path", F.when(F.col("crlf"), F.regexp_replace("record", "\r(\n|\\z)", "$1"))
                    .otherwise(F.col("record")).alias("record"), "first"))


def _inside(lines: DataFrame, open_ranges: np.ndarray, crlf_files: np.ndarray) -> DataFrame:
    """(path, record, first): the records that lie whole in a range."""
    shared = lines.sparkSession.sparkContext.broadcast((open_ranges, crlf_files))

    def run(batches):
        open_at, crlf_files = shared.value
        quotes, held, first, crlf = 0, None, False, False
        for (path, start), new, part in _ranges(batches):
            if new:
                inside = bool(np.isin(_range_hash(path, start), open_at))
                # `held` has the lines of the record at hand, None while it began before the range.
                quotes, held, first = int(inside), None if inside else [], start == 0
                crlf = bool(np.isin(_range_hash(path, -1), crlf_files))
            part = part.without_returns() if crlf else part
            after = quotes + part.quotes[1:]
            ends = np.flatnonzero(after % 2 == 0)
            quotes += int(part.quotes[-1])
            n = len(part.offsets) - 1
            if not len(ends):
                if held is not None:
                    held.append(part.text(0, n))
                continue
            begin = 0
            if held is None:  # the end of a record from before
                begin, held = int(ends[0]) + 1, []
                ends = ends[1:]
            elif held:
                record = b"\n".join([*held, part.text(0, int(ends[0]) + 1)])
                out = _batch(path, pa.array([record], pa.binary()), first)
                yield out
                begin, held, first = int(ends[0]) + 1, [], first and not out.column(2)[0].as_py()
                ends = ends[1:]
            if len(ends):
                out = _batch(path, _joined(part, begin, ends), first)
                yield out
                begin, first = int(ends[-1]) + 1, first and not pc.any(out.column(2)).as_py()
            if begin < n:
                held.append(part.text(begin, n))

    return lines.mapInArrow(run, "path string, record binary, first boolean").select(
        "path", F.col("record").cast("string").alias("record"), "first")


def _joined(lines: _Lines, begin: int, ends: np.ndarray) -> pa.Array:
    """Lines from `begin` on as records that end with the lines `ends`, breaks kept inside them."""
    stop = int(ends[-1]) + 1
    offsets = lines.offsets[begin:stop + 1]
    data = lines.data[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n = stop - begin
    out = np.full(len(data) + n, _LF, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    keep = np.ones(len(out), bool)
    last = offsets[ends + 1 - begin] + (ends - begin)  # the breaks at the ends of records
    keep[last] = False
    begins = np.concatenate([[0], last[:-1] + 1])
    sizes = np.add.reduceat(keep.astype(np.int64), begins)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).tobytes()),
                                       pa.py_buffer(out[keep].tobytes())]).cast(pa.binary())


def _batch(path: str, records: pa.Array, first: bool) -> pa.RecordBatch:
    """With `first`, the first record that is not empty is marked."""
    flags = np.zeros(len(records), bool)
    if first:
        flags[np.flatnonzero(pc.binary_length(records).to_numpy())[:1]] = True
    return pa.RecordBatch.from_arrays(
        [pa.array([path], pa.string()).take(pa.array(np.zeros(len(records), np.int32))), records,
         pa.array(flags)], ["path", "record", "first"])


def _range_hash(path: str, start: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{start}:{path}".encode(), digest_size=8).digest(), "little")


def split_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, record, first): the records of CSV files as text, line breaks inside quotes kept.

    Quotes must stand for quoting only: around a field, and doubled inside it (`malformed` finds
    records that break that rule). Records end with a line feed. Where the first line of a file ends
    with carriage return and line feed, both are one break in that file, also inside quotes, as
    Spark's reader has it. Empty lines are no records. `first` marks the first record of a file, its
    header. Runs one pass over the files at once, to learn how ranges begin; the driver sees 8 bytes
    for each range that begins inside a record, and for each file with carriage returns.
    """
    path = path if isinstance(path, str) else list(path)
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("start"),
                     F.col("value").cast("binary").alias("value")))
    borders = written(_borders(lines), "csv_borders")
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    borders = borders.withColumn("inside", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    crlf = F.first(F.when(F.col("start") == 0, F.col("crlf")), ignorenulls=True).over(W.partitionBy("path"))
    borders = borders.withColumn("crlf", F.coalesce(crlf, F.lit(False)))

    def hashes(rows: DataFrame) -> np.ndarray:
        return np.sort(np.array([_range_hash(*r) for r in rows.toLocalIterator()], np.uint64))

    records = _inside(lines, hashes(borders.where("inside = 1").select("path", "start")),
                      hashes(borders.where("start = 0 and crlf").select("path", F.lit(-1)))).union(
        _stitched(borders))
    return (records.withColumn("record", F.when(F.col("first"), F.ltrim("record", F.lit(_BOM)))
                               .otherwise(F.col("record")))
            .where("record <> ''"))


def malformed(records: DataFrame) -> DataFrame:
    """Records with a quote where none should stand, or with one that is not closed."""
    return records.where(~F.col("record").rlike(_WELL_FORMED))


def parsed(records: DataFrame, schema: T.StructType, header: bool = True) -> DataFrame:
    """Records as text columns named by `schema`, by position; short ones filled with NULL."""
    ddl = ", ".join("`" + f.name.replace("`", "``") + "` STRING" for f in as_strings(schema).fields)
    rows = records.where(~F.col("first")) if header else records
    row = F.from_csv("record", ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    return rows.select(row.alias("row")).select("row.*")


def read_csv_split(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    header: bool = True,
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """As `read_csv` with `multiline`, but each file is read by as many tasks as it has ranges."""
    return null_tokens(parsed(split_records(spark, path), schema, header), tokens)
