"""Small helpers that several operators share: sorted runs, salts, Arrow output."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_runs(batches: Iterable[pa.RecordBatch],
             keys: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """Rows of one key at a time, from batches sorted by `keys` (integers, no nulls).

    Only the run at hand is held. Callers split large keys before, so a run is bounded.
    """
    held: list[dict[str, np.ndarray]] = []
    key = None

    def joined():
        return {k: np.concatenate([h[k] for h in held]) for k in held[0]}

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = {name: batch.column(i).to_numpy(zero_copy_only=False)
                for i, name in enumerate(batch.schema.names)}
        new = np.zeros(n, bool)
        for k in keys:
            new[1:] |= cols[k][1:] != cols[k][:-1]
        starts = np.concatenate([[0], np.flatnonzero(new), [n]])
        for a, b in zip(starts[:-1], starts[1:]):
            here = tuple(int(cols[k][a]) for k in keys)
            if key is not None and here != key:
                yield key, joined()
                held = []
            key = here
            held.append({k: v[a:b] for k, v in cols.items()})
    if held:
        yield key, joined()


def partitions(df: DataFrame) -> int:
    """How many partitions the session shuffles into; the measure for salts."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, mod n; null where the column is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)


def merge_labels(labels: np.ndarray, members: np.ndarray) -> None:
    """Give all groups that have one of `members` (positions) the smallest of their labels."""
    met = labels[members]
    low = met.min()
    if low != met.max():
        labels[np.isin(labels, np.unique(met))] = low


def unused(columns: list[str], name: str) -> str:
    """`name` with as many underscores before it as no column has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
