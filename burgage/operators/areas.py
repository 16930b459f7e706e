"""Points to the areas they lie in: an equi-join on grid cells, and an exact test at borders.

An area is a WKT polygon or multipolygon, holes included. It is cut into cells of a grid. Cells that
no edge passes are inside or outside as a whole; a border cell keeps the edges that a ray to the
right from some of its points crosses and from others not, and whether those that all cross are
odd in number. So a point meets the areas of its cell only, most points need no further test, and
no task sees a whole area's edges for a point far from them.

Both sides may be small and what they have in common large, so sizes say little about the work: it
is dealt into all the tasks that the session shuffles into, a cell with many points to several.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = "double"
PLAIN_EDGES = 8       # edges of a border cell that are tested without a lambda function
PIECE_POINTS = 4096   # points of a cell that stay together


def rings(wkt: Column) -> Column:
    """The rings of a WKT polygon or multipolygon as arrays of (x, y)."""
    def point(text: Column) -> Column:
        parts = F.split(F.trim(text), r"\s+")
        return F.struct(F.get(parts, F.lit(0)).try_cast(_NUMBER).alias("x"),
                        F.get(parts, F.lit(1)).try_cast(_NUMBER).alias("y"))

    found = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(found, lambda r: F.transform(F.split(r, ","), point))


def edges(wkt: Column) -> Column:
    """The edges (x1, y1, x2, y2) of all rings, unclosed ones closed; those with a coordinate that is
    no number are left out."""
    def of_ring(r: Column) -> Column:
        closed = F.concat(r, F.slice(r, 1, 1))
        pairs = F.arrays_zip(F.slice(closed, 1, F.size(r)).alias("a"),
                             F.slice(closed, 2, F.size(r)).alias("b"))
        return F.transform(pairs, lambda p: F.struct(
            p["a"]["x"].alias("x1"), p["a"]["y"].alias("y1"),
            p["b"]["x"].alias("x2"), p["b"]["y"].alias("y2")))

    return F.filter(F.flatten(F.transform(rings(wkt), of_ring)), lambda e: F.coalesce(
        F.abs(e["x1"] + e["x2"] + e["y1"] + e["y2"]) < float("inf"), F.lit(False)))


def _crossed(e: Column | dict[str, Column], x: Column, y: Column) -> Column:
    """Whether a ray to the right from (x, y) crosses an edge; a corner belongs to its upper edge, and
    an edge that lies level is never crossed."""
    return (((e["y1"] > y) != (e["y2"] > y))
            & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))


def inside(e: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) lies inside the edges: a ray from it crosses an odd number of them."""
    return F.size(F.filter(e, lambda one: _crossed(one, x, y))) % 2 == 1


def _flat(e: Column) -> dict[str, Column]:
    """At most PLAIN_EDGES edges as columns of numbers; missing ones lie level and are never crossed."""
    return {f"_{c}_{i}": F.coalesce(F.get(e, F.lit(i))[c], F.lit(0.0))
            for i in range(PLAIN_EDGES) for c in ("x1", "y1", "x2", "y2")}


def _flat_odd(odd: Column, x: Column, y: Column) -> Column:
    """Whether a ray crosses an odd number of flat edges and others. Without lambda functions and nulls, so
    that the test is compiled into one short loop with the join before it."""
    return reduce(lambda a, b: a != b, [_crossed(
        {c: F.col(f"_{c}_{i}") for c in ("x1", "y1", "x2", "y2")}, x, y) for i in range(PLAIN_EDGES)], odd)


def area_cells(areas: DataFrame, id_col: str, wkt_col: str, cell: float) -> DataFrame:
    """(area, _cx, _cy, _edges, _odd): the cells of each area; `_edges` is NULL where the whole cell
    lies inside. `_odd` says whether every ray to the right from the cell crosses an odd number of
    other edges. An area is cut row by row, so the work grows with its cells and its edges in each row."""
    shapes = areas.select(F.col(id_col).alias("area"), edges(F.col(wkt_col)).alias("_all")) \
        .where(F.size("_all") > 0)
    least = F.array_min(F.transform("_all", lambda e: F.least(e["y1"], e["y2"])))
    most = F.array_max(F.transform("_all", lambda e: F.greatest(e["y1"], e["y2"])))
    rows = shapes.select("area", "_all", F.explode(F.sequence(
        F.floor(least / cell), F.floor(most / cell))).alias("_cy"))
    low, high = F.col("_cy") * cell, (F.col("_cy") + 1) * cell

    def clipped(e: Column) -> Column:
        """The edge with its span of x within the row, a little wider than computed."""
        def at(y: Column) -> Column:
            y = F.least(F.greatest(y, F.least(e["y1"], e["y2"])), F.greatest(e["y1"], e["y2"]))
            return e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"])

        level, slack = e["y1"] == e["y2"], (F.abs(e["x1"]) + F.abs(e["x2"])) * 1e-9
        first = F.when(level, e["x1"]).otherwise(at(low))
        last = F.when(level, e["x2"]).otherwise(at(high))
        past = (F.abs(low) + F.abs(high)) * 1e-9
        through = ((F.least(e["y1"], e["y2"]) < low - past) & (F.greatest(e["y1"], e["y2"]) > high + past))
        return F.struct(e.alias("e"), (F.least(first, last) - slack).alias("left"),
                        (F.greatest(first, last) + slack).alias("right"), through.alias("through"))

    here = F.filter("_all", lambda e: (F.least(e["y1"], e["y2"]) < high) & (F.greatest(e["y1"], e["y2"]) >= low))
    rows = rows.select("area", "_cy", F.transform(here, clipped).alias("_row")).where(F.size("_row") > 0)
    cells = rows.select("area", "_cy", "_row", F.explode(F.sequence(
        F.floor(F.array_min(F.transform("_row", lambda e: e["left"])) / cell),
        F.floor(F.array_max(F.transform("_row", lambda e: e["right"])) / cell))).alias("_cx"))
    left, right = F.col("_cx") * cell, (F.col("_cx") + 1) * cell
    border = F.exists("_row", lambda e: (e["left"] <= right) & (e["right"] >= left))
    ahead = F.filter("_row", lambda e: e["right"] >= left)
    cells = cells.select("area", "_cx", "_cy", border.alias("_border"), ahead.alias("_ahead"))
    # Every ray from the cell crosses an edge that lies beyond it and goes through the whole row.
    sure = lambda e: e["through"] & (e["left"] > right)
    cells = cells.select(
        "area", "_cx", "_cy", "_border", (F.size(F.filter("_ahead", sure)) % 2 == 1).alias("_odd"),
        F.transform(F.filter("_ahead", lambda e: ~sure(e) & (e["e"]["y1"] != e["e"]["y2"])),
                    lambda e: e["e"]).alias("_edges"))
    centre = (F.col("_cx") + 0.5) * cell, (F.col("_cy") + 0.5) * cell
    return cells.where(F.col("_border") | (inside(F.col("_edges"), *centre) != F.col("_odd"))).select(
        "area", "_cx", "_cy", F.when(F.col("_border"), F.col("_edges")).alias("_edges"), "_odd")


def _hashable(kind: T.DataType) -> bool:
    return isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)


def points_in_areas(points: DataFrame, areas: DataFrame, *, x: str, y: str, area_id: str, wkt: str,
                    cell: float, name: str = "area") -> DataFrame:
    """`points` with the id of the area they lie in as `name`; a row for each area of a point.

    Points outside all areas have no row, nor have those without a coordinate. Of two areas that share
    a border a point on it lies in one. `cell` is the side of a grid cell: areas should have some
    cells each, and cells some points. Points are counted per cell first: a cell of many is dealt in
    pieces, each of which meets the cell's areas in a task of its own.
    """
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    there = F.abs(F.col(x).cast(_NUMBER) + F.col(y).cast(_NUMBER)) < float("inf")
    placed = points.where(F.coalesce(there, F.lit(False))).withColumns(
        {"_cx": F.floor(F.col(x) / cell), "_cy": F.floor(F.col(y) / cell)})
    pieces = placed.groupBy("_cx", "_cy").agg(F.ceil(F.count("*") / PIECE_POINTS).alias("_pieces"))
    cells = area_cells(areas.select(area_id, wkt).repartition(tasks), area_id, wkt, cell)
    cells = cells.join(pieces, ["_cx", "_cy"]).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1))).drop("_pieces")
    own = F.xxhash64(*[f"`{f.name}`" for f in points.schema.fields if _hashable(f.dataType)])
    placed = placed.join(pieces, ["_cx", "_cy"]).withColumn(
        "_piece", F.pmod(own, F.col("_pieces"))).drop("_pieces")
    keys = ["_cx", "_cy", "_piece"]
    at = F.col(x).cast(_NUMBER), F.col(y).cast(_NUMBER)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, *keys)

    few = F.col("_edges").isNull() | (F.size("_edges") <= PLAIN_EDGES)
    whole = F.col("_edges").isNull()
    flat = dealt(cells.where(few)).select("area", *keys, "_odd", whole.alias("_whole"), *[
        c.alias(n) for n, c in _flat(F.col("_edges")).items()])
    plain = dealt(placed).join(flat, keys).where(F.col("_whole") | _flat_odd(F.col("_odd"), *at))
    other = dealt(placed).join(dealt(cells.where(~few)), keys).where(
        inside(F.col("_edges"), *at) != F.col("_odd"))
    out = [*points.columns, F.col("area").alias(name)]
    return plain.select(*out).union(other.select(*out))
