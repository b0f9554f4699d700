"""Exact nearest-neighbour join on the sphere without comparing all pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galepost.functions.geo import box_floor_sql, distance_km, distance_sql
from galepost.session import stage

# Sides of the nested search cells in degrees, each an eighth of the one before. The
# coarsest grid bounds the number of cells every position starts from. A cell with more than
# LEAF_POINTS targets is split, whatever the others do, so a crowd is searched finely and a
# plain is not.
CELL_DEGREES = tuple(8.0**power for power in range(1, -7, -1))
LEAF_POINTS = 32
# Slack for floating point and for ranking on distances rounded to the millimetre.
SLACK_KM = 0.001
BOX = ("south", "north", "west", "east", "south_lng")


def _cell(degrees: float) -> str:
    """Number of a target's grid cell; longitudes lie in [-180, 180)."""
    row, column = (f"floor((t_lat + 90) / {degrees}D)", f"floor((t_lng + 180) / {degrees}D)")
    return f"{row} * 4294967296L + {column}"


def _wrapped(lng: Column) -> Column:
    inside = (lng >= -180.0) & (lng < 180.0)
    return F.when(inside, lng).otherwise(F.pmod(lng + 180.0, F.lit(360.0)) - 180.0)


def _paths(degrees: tuple[float, ...]) -> str:
    """A target's cells in all grids, as rows."""
    steps = ", ".join(
        f"struct({level} as level, {_cell(parent)} as parent, {_cell(child)} as child)"
        for level, (parent, child) in enumerate(zip((degrees[0], *degrees), degrees))
    )
    return f"inline(array({steps}))"


def _search_tree(
    targets: DataFrame, degrees: tuple[float, ...], leaf_points: int
) -> DataFrame:
    """The cells of a tree of uneven depth: parent cell, bounding box, one member, and whether
    it is a leaf. Of each grid but the coarsest there are the cells whose parent is split."""
    cells = (
        targets.select("t_lat", "t_lng", F.expr(_paths(degrees)))
        .groupBy("level", "parent", "child")
        .agg(
            F.min("t_lat").alias("south"),
            F.max("t_lat").alias("north"),
            F.min("t_lng").alias("west"),
            F.max("t_lng").alias("east"),
            F.expr("min_by(t_lng, struct(t_lat, t_lng))").alias("south_lng"),
            F.count(F.lit(1)).alias("points"),
        )
    )
    # A cell has 64 children at most.
    in_parent = F.sum("points").over(Window.partitionBy("level", "parent"))
    is_leaf = (F.col("points") <= leaf_points) | (F.col("level") == len(degrees) - 1)
    return (
        cells.withColumn("_in_parent", in_parent)
        .filter((F.col("level") == 0) | (F.col("_in_parent") > leaf_points))
        .select("level", "parent", "child", is_leaf.alias("is_leaf"), *BOX)
    )


# What a cell in ``nodes`` offers a position: no target of it is nearer than floor_km, and one
# lies at reached_km.
_SIDES = [f"n.{side}" for side in BOX]
_SCORED = f"""transform(nodes, n -> struct(
    n.child as child,
    n.is_leaf as is_leaf,
    {box_floor_sql("p_lat", "p_lng", *_SIDES[:4])} as floor_km,
    {distance_sql("p_lat", "p_lng", "n.south", "n.south_lng")} as reached_km))"""
_WITHIN = f"floor_km <= best_km + {SLACK_KM}D"
_NODE = ("child", "is_leaf", *BOX)


def _survivors(opened: DataFrame) -> DataFrame:
    """The cells of ``nodes`` that can still beat the best distance reached in them or before."""
    return (
        opened.withColumn("nodes", F.expr(_SCORED))
        .withColumn(
            "best_km",
            F.least("best_km", F.expr("array_min(transform(nodes, n -> n.reached_km))")),
        )
        .select("p_lat", "p_lng", "best_km", F.expr(f"inline(filter(nodes, n -> n.{_WITHIN}))"))
        .drop("reached_km")
    )


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    left_point: str,
    right_id: str,
    right_point: str,
    id_name: str,
    distance_name: str,
    cell_degrees: tuple[float, ...] = CELL_DEGREES,
    leaf_points: int = LEAF_POINTS,
) -> DataFrame:
    """Add to each left row the id of its closest right point and the distance in km.

    Points are structs (lng, lat). Ties go to the smaller id, a NULL id last. A left row
    without a point gets the smallest id and a NULL distance; without right rows nothing
    comes out.

    The search runs once per distinct left position and descends through nested cells, split
    where they are crowded. At each level the surviving cells are opened. A child's box gives
    the least distance it can offer, one of its points a distance that is certainly reached,
    and children that cannot beat the best reached one are dropped, inside the row as far as
    they are of one parent. A position leaves the descent at its leaves; only what lies near
    a crowd goes on to the next level.

    The distinct right points and the tree are written once, since every level reads them
    while ``right`` may be a long daily history, and so are the cells that survive a level.
    """
    point = F.col(right_point)
    targets = stage(
        right.select(
            point["lat"].alias("t_lat"),
            _wrapped(point["lng"]).alias("t_lng"),
            F.col(right_id).alias("t_id"),
        )
        .groupBy("t_lat", "t_lng")
        .agg(F.min("t_id").alias("t_id")),
        "nearest-points",
    )
    members = targets.filter("t_lat is not null and t_lng is not null")
    tree = stage(_search_tree(members, cell_degrees, leaf_points), "nearest-cells")
    positions = (
        left.filter(F.col(left_point).isNotNull())
        .select(
            F.col(f"{left_point}.lat").alias("p_lat"), F.col(f"{left_point}.lng").alias("p_lng")
        )
        .distinct()
    )
    position = Window.partitionBy("p_lat", "p_lng")
    # The occupied coarse cells: at most 24 x 45 with the default grids.
    coarse = tree.filter("level = 0").agg(F.collect_list(F.struct(*_NODE))).scalar()
    deepest = tree.agg(F.max("level")).first()[0] or 0
    opened = positions.withColumns({"best_km": F.lit(float("inf")), "nodes": coarse})
    cells = _survivors(opened)
    reached_leaves = []
    for level in range(1, deepest + 1):
        cells = stage(cells, "nearest-survivors")
        reached_leaves.append(cells.filter("is_leaf").withColumn("level", F.lit(level - 1)))
        children = (
            tree.filter(F.col("level") == level)
            .groupBy(F.col("parent").alias("_parent"))
            .agg(F.collect_list(F.struct(*_NODE)).alias("nodes"))
        )
        opened = cells.filter("not is_leaf").join(children, F.col("child") == F.col("_parent"))
        cells = (
            _survivors(opened.select("p_lat", "p_lng", "best_km", "nodes"))
            .withColumn("best_km", F.min("best_km").over(position))
            .filter(_WITHIN)
        )
    reached_leaves.append(cells.withColumn("level", F.lit(deepest)))
    leaves = members.select("*", F.expr(_paths(cell_degrees))).join(
        tree.filter("is_leaf").select("level", "parent", "child"), ["level", "parent", "child"]
    )
    km = distance_km("p_lat", "p_lng", "t_lat", "t_lng")
    nearest = F.struct(km.alias("km"), F.isnull("t_id").alias("no_id"), "t_id")
    closest = (
        reduce(DataFrame.unionByName, reached_leaves)
        .select("p_lat", "p_lng", "level", "child")
        .join(leaves.select("level", "child", "t_lat", "t_lng", "t_id"), ["level", "child"])
        .groupBy("p_lat", "p_lng")
        .agg(F.min(nearest).alias("closest"))
    )
    smallest_id = targets.select(F.min("t_id")).scalar()
    return (
        left.join(
            closest,
            F.expr(f"{left_point}.lat = p_lat and {left_point}.lng = p_lng"),
            "left",
        )
        .withColumn(
            id_name, F.when(F.col("closest").isNull(), smallest_id).otherwise(F.col("closest.t_id"))
        )
        .withColumn(distance_name, F.col("closest.km"))
        .filter(targets.select(F.count(F.lit(1)) > 0).scalar())
        .drop("p_lat", "p_lng", "closest")
    )
