"""Reports as mergeable states: one scan for many reports, and new batches without the old rows.

A view says by which keys rows are grouped, what is measured, and how its report follows from the
groups. Every measure is one that can be put together from parts (counts, sums, least and greatest
values, sketches), and medians come from counts per value. So the state of two batches together is
made from their states, `pack` finds the states of many views in one scan by grouping sets, and
`fold` stores a batch's states, so that a report after a new batch costs a scan of that batch only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DAYS_RANGE, TOP_FLOWS, TOP_PLACES, TREND_YEARS
from ..session import written
from .quantiles import quantiles_of_counts


class Measure(NamedTuple):
    """How a column of a state is found from rows, and from other states."""

    of_rows: Callable[[], Column]
    of_states: Callable[[str], Column]


def count() -> Measure:
    return Measure(lambda: F.count("*"), F.sum)


def present(column: str) -> Measure:
    return Measure(lambda: F.count(column), F.sum)


def total(column: str) -> Measure:
    return Measure(lambda: F.sum(column), F.sum)


def least(column: str) -> Measure:
    return Measure(lambda: F.min(column), F.min)


def greatest(column: str) -> Measure:
    return Measure(lambda: F.max(column), F.max)


def sketch(column: str, bits: int = 14) -> Measure:
    """A HyperLogLog sketch of the distinct values, about 1 percent off with 14 bits."""
    return Measure(lambda: F.hll_sketch_agg(column, bits), lambda name: F.hll_union_agg(name))


class View(NamedTuple):
    keys: tuple[str, ...]
    measures: Mapping[str, Measure]
    report: Callable[[DataFrame], DataFrame]


def trend(years: tuple[int, int] = TREND_YEARS, *, year: str = "issued_year",
          category: str = "permit_type") -> View:
    """Rows per year and category, as `activity.trend`."""
    return View((year, category), {"n": count()}, lambda s: s.filter(F.col(year).between(*years)).select(
        year, category, F.col("n").alias("permit_count")))


def place_activity(k: int | None = TOP_PLACES, *, place: str = "neighborhood",
                   days: str = "processing_days", cost: str = "estimated_cost") -> View:
    """As `activity.place_activity`. The mean is that of all batches, not a mean of means."""
    def report(s: DataFrame) -> DataFrame:
        found = s.filter(F.col(place).isNotNull()).select(
            place, F.col("n").alias("total_permits"),
            F.try_divide(F.col("days").cast("double"), "timed").alias("avg_processing_days"),
            F.col("cost").alias("total_estimated_cost"))
        return found if k is None else found.orderBy(F.desc("total_permits"), place).limit(k)

    return View((place,), {"n": count(), "days": total(days), "timed": present(days),
                           "cost": total(cost)}, report)


def quality_summary(*, place: str = "neighborhood", year: str = "issued_year",
                    days: str = "processing_days") -> View:
    """As `activity.quality_summary`; the state has a row per place, so distinct places are exact."""
    def report(s: DataFrame) -> DataFrame:
        return s.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.min("first").alias("min_year"), F.max("last").alias("max_year"),
            F.try_divide(F.sum("days").cast("double"), F.sum("timed")).alias("avg_processing_days"),
            F.count(place).alias("distinct_neighborhoods"))

    return View((place,), {"n": count(), "days": total(days), "timed": present(days),
                           "first": least(year), "last": greatest(year)}, report)


def processing_stats(days_range: tuple[int, int] | None = DAYS_RANGE, *, category: str = "permit_type",
                     days: str = "processing_days", digits: int = 1) -> View:
    """As `timing.processing_stats`: the state counts rows per category and day, hence the median."""
    def report(s: DataFrame) -> DataFrame:
        s = s if days_range is None else s.filter(F.col(days).between(*days_range))
        mean = F.try_divide(F.sum(F.col(days) * F.col("n")).cast("double"),
                            F.sum(F.when(F.col(days).isNotNull(), F.col("n"))))
        return s.groupBy(category).agg(
            F.sum("n").alias("count"), F.round(mean, digits).alias("avg_days"),
            F.percentile(F.col(days), 0.5, F.col("n")).alias("median_days"),
            F.min(days).alias("min_days"), F.max(days).alias("max_days"))

    return View((category, days), {"n": count()}, report)


def change_of_use(k: int | None = TOP_FLOWS, *, source: str = "existing_use",
                  target: str = "proposed_use") -> View:
    """Rows per pair of different labels, as written; the k largest."""
    def report(s: DataFrame) -> DataFrame:
        s = s.filter(F.col(source) != F.col(target)).select(source, target, F.col("n").alias("flow_count"))
        return s if k is None else s.orderBy(F.desc("flow_count"), source, target).limit(k)

    return View((source, target), {"n": count()}, report)


def value_quantiles(value: str, probs: tuple[float, ...], keys: tuple[str, ...] = (),
                    names: tuple[str, ...] | None = None) -> View:
    """Exact quantiles of a measure; the state counts rows per value."""
    return View((*keys, value), {"n": count()}, lambda s: quantiles_of_counts(
        s.filter(F.col(value).isNotNull()), value, "n", probs, keys, names))


def distinct_values(column: str, keys: tuple[str, ...] = (), bits: int = 14) -> View:
    """About how many distinct values each key group has, by a sketch of fixed size."""
    return View(keys, {"seen": sketch(column, bits)}, lambda s: s.select(
        *keys, F.hll_sketch_estimate("seen").alias("distinct_values")))


def state(rows: DataFrame, view: View) -> DataFrame:
    """The state of a view over some rows."""
    return rows.groupBy(*view.keys).agg(*[m.of_rows().alias(n) for n, m in view.measures.items()])


def merged(parts: DataFrame, view: View) -> DataFrame:
    """States below each other as one."""
    return parts.groupBy(*view.keys).agg(*[m.of_states(n).alias(n) for n, m in view.measures.items()])


def pack(rows: DataFrame, views: Mapping[str, View]) -> dict[str, DataFrame]:
    """The states of all views from one scan of `rows`, at once, by grouping sets.

    Each row goes into the partial counts of every key set where it is read, so what is shuffled
    is the states. A measure of one name must be the same in all views. The states
    are written together; each one returned reads its part.
    """
    keys = list(dict.fromkeys(k for v in views.values() for k in v.keys))
    measures = reduce(lambda a, b: {**a, **b.measures}, views.values(), {})
    sets = list(dict.fromkeys(frozenset(v.keys) for v in views.values()))
    number = {s: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s) for s in sets}
    all_states = written(
        rows.groupingSets([[k for k in keys if k in s] for s in sets], *keys).agg(
            F.grouping_id().cast("long").alias("_set"), *[m.of_rows().alias(n) for n, m in measures.items()]),
        "pack")
    return {name: all_states.filter(F.col("_set") == number[frozenset(v.keys)]).select(
        *v.keys, *v.measures) for name, v in views.items()}


def reports(rows: DataFrame, views: Mapping[str, View]) -> dict[str, DataFrame]:
    """The reports of all views from one scan."""
    return {name: views[name].report(s) for name, s in pack(rows, views).items()}


def _folder(path: str, name: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"a batch is named by letters, digits and _ . - only, not {batch!r}")
    return f"{path.rstrip('/')}/{name}/batch={batch}"


def fold(rows: DataFrame, views: Mapping[str, View], path: str, batch: str) -> None:
    """Store the states of a batch of rows below `path`, in place of that batch's if it is there.

    So a batch that is delivered again, amended or not, never counts twice, and a job that failed can
    just be run again. The batch is scanned once for all views.
    """
    folders = {name: _folder(path, name, batch) for name in views}
    for name, s in pack(rows, views).items():
        s.write.mode("overwrite").parquet(folders[name])


def folded(spark: SparkSession, views: Mapping[str, View], path: str) -> dict[str, DataFrame]:
    """The reports over all batches below `path`, from their states alone."""
    return {name: v.report(merged(_stored(spark, path, name), v)) for name, v in views.items()}


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")


def compact(spark: SparkSession, views: Mapping[str, View], path: str, new_path: str, batch: str) -> None:
    """Write all batches below `path` as one batch below `new_path`; batches that may still be
    delivered again should not be among them."""
    for name, v in views.items():
        merged(_stored(spark, path, name).drop("batch"), v).write.mode("overwrite").parquet(
            _folder(new_path, name, batch))
