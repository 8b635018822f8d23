"""Points to polygons without a geometry library.

Polygons are cut into the cells of a grid (``prepare_polygons``): a piece holds the edges that pass
its cell and whether the cell's lower left corner is inside, which decides for every point of
the cell. Cells wholly inside hold no edges. Points meet the pieces of their own cell, and for the
nearest polygon those of a pyramid of cells whose lower bound is below the least upper bound.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiframe.functions.geo import contained_in_cell, edge_distance, project_point, ring_edges
from civiframe.operators.joins import spread_left_join
from civiframe.session import Staged

#: Side of a cell in metres, and where the grid begins: its lines meet no outline's corner exactly.
CELL = 2_000.0
ORIGIN = CELL * (math.sqrt(5) - 2)
#: A cell of the pyramid is as wide as so many of the level below; the top level is one cell, the plane.
FAN_BITS = 2
TOP = 10
#: Metres added where an edge is dealt to cells and where bounds are compared.
SLACK = 1e-3


def _cell(value: Column) -> Column:
    return F.floor((value - ORIGIN) / CELL)


def _line(cell: Column) -> Column:
    """Where a cell begins."""
    return cell * CELL + ORIGIN


def _span(low: Column, high: Column) -> Column:
    return F.when(low <= high, F.sequence(low, high))


def prepare_polygons(polygons: DataFrame, rings: str = "rings") -> DataFrame:
    """Polygons with their ``pieces`` (``cx, cy, inside, edges``) instead of the rings, stored
    once: the joins below read them several times. An edge is stored for each cell that it passes."""
    work = Staged(polygons.sparkSession)
    numbered = polygons.withColumns({"_outline": F.monotonically_increasing_id(), "_edges": ring_edges(F.col(rings))})
    table = work.put(numbered.drop(rings), "outlines")
    edges = table.select("_outline", F.array_min(F.transform("_edges", lambda e: e.x1)).alias("_left"), F.explode("_edges").alias("e"))
    low, high = {}, {}
    for axis in "xy":
        first, second = F.col(f"e.{axis}1"), F.col(f"e.{axis}2")
        low[axis], high[axis] = F.least(first, second), F.greatest(first, second)

    slope = (F.col("e.y2") - F.col("e.y1")) / (F.col("e.x2") - F.col("e.x1"))
    at = lambda x: F.when(F.col("e.x1") == F.col("e.x2"), None).otherwise(F.col("e.y1") + (x - F.col("e.x1")) * slope)
    enters, leaves = at(F.greatest(low["x"], _line(F.col("cx")))), at(F.least(high["x"], _line(F.col("cx") + 1)))
    bottom = F.greatest(low["y"], F.least(enters, leaves) - SLACK)  # the whole height of an upright edge
    top = F.least(high["y"], F.greatest(enters, leaves) + SLACK)
    passed = (
        edges.withColumn("cx", F.explode(_span(_cell(low["x"] - SLACK), _cell(high["x"] + SLACK))))
        .withColumn("cy", F.explode(_span(_cell(bottom - SLACK), _cell(top + SLACK))))
        .select("_outline", "cx", "cy", "e")
    )
    # an edge that crosses the line below a row of cells changes the state of the corners to its left
    crossing = F.col("e.x1") + (_line(F.col("cy")) - F.col("e.y1")) / slope
    crossed = (
        edges.withColumn("cy", F.explode(_span(_cell(low["y"]) + 1, _cell(high["y"]))))
        .withColumn("_x", F.when(F.col("e.x1") == F.col("e.x2"), F.col("e.x1")).otherwise(crossing))
        .withColumn("cx", F.explode(_span(_cell(F.col("_left")), _cell(F.col("_x")))))
        .select("_outline", "cx", "cy", F.lit(None).cast(edges.schema["e"].dataType).alias("e"))
    )
    piece = F.struct("cx", "cy", "inside", "edges")
    pieces = (
        passed.unionAll(crossed)
        .groupBy("_outline", "cx", "cy")
        .agg((F.count_if(F.col("e").isNull()) % 2 == 1).alias("inside"), F.collect_list("e").alias("edges"))
        .where(F.col("inside") | (F.size("edges") > 0))
        .groupBy("_outline")
        .agg(F.collect_list(piece).alias("pieces"))
    )
    out = work.put(table.join(pieces, "_outline", "left").drop("_outline", "_edges"), "polygons")
    work.drop(table)
    return out


def with_projection(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    x, y = project_point(F.col(latitude).try_cast("double"), F.col(longitude).try_cast("double"))
    return df.withColumns({"px": x, "py": y})


def _in_piece() -> Column:
    corner = _line(F.col("_cx")), _line(F.col("_cy"))
    return contained_in_cell(F.col("_piece.edges"), F.col("_piece.inside"), corner, F.col("px"), F.col("py"))


def _pieces(polygons: DataFrame, *columns: Column | str) -> DataFrame:
    rows = polygons.select(*columns, F.explode("pieces").alias("_piece"))
    return rows.select("*", F.col("_piece.cx").alias("_cx"), F.col("_piece.cy").alias("_cy"))


def attach_containing(points: DataFrame, polygons: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Left join of points (``px, py``) with every polygon that contains them."""
    own = (_cell(F.col("px")) == F.col("_cx")) & (_cell(F.col("py")) == F.col("_cy"))
    joined = points.join(_pieces(polygons, *attributes), own & _in_piece(), "left")
    return joined.select(*points.columns, *attributes)


def _above(cell: Column, level: Column) -> Column:
    """Cell of a level of the pyramid that holds a cell of the lowest one."""
    return F.when(level >= TOP, F.lit(0)).otherwise(F.call_function("shiftright", cell.cast("long"), (level * FAN_BITS).cast("int"))).cast("long")


def _around(level: Column, cx: Column, cy: Column) -> Column:
    """Cells beside a cell, itself included; the top has no other."""
    steps = F.when(level >= TOP, F.array(F.lit(0))).otherwise(F.array(*map(F.lit, (-1, 0, 1))))
    return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((cx + i).alias("cx"), (cy + j).alias("cy")))))


def _side_of(level: Column) -> Column:
    return CELL * F.pow(F.lit(2.0), level * FAN_BITS)


def nearest_cells(points: DataFrame, polygons: DataFrame, work: Staged) -> DataFrame:
    """``(px, py, cx, cy)``: the occupied cells that can hold the nearest polygon of each distinct point.

    A first pass finds for every point the lowest level of the pyramid that has an occupied
    cell within one cell of its own; this bounds its distance. From the cells one level above, the
    second pass goes down level by level: a cell stays if its nearest place is not beyond the least
    of the farthest places of the point's cells.
    """
    distinct = points.select("px", "py").where("px is not null and py is not null").distinct()
    levels = F.explode(F.sequence(F.lit(0), F.lit(TOP - 1))).alias("level")
    occupied = _pieces(polygons).select("_cx", "_cy").distinct().select("_cx", "_cy", levels)
    tiles = work.put(
        occupied.select("level", _above(F.col("_cx"), F.col("level")).alias("tx"), _above(F.col("_cy"), F.col("level")).alias("ty")).distinct(), "tiles"
    )
    beside = tiles.select(F.col("level").alias("_level"), F.explode(_around(F.col("level"), F.col("tx"), F.col("ty"))).alias("t"))
    own = distinct.select("px", "py", levels)
    own = own.withColumns({n: _above(_cell(F.col(p)), F.col("level")) for n, p in (("cx", "px"), ("cy", "py"))})
    seen = own.join(
        beside, (F.col("level") == F.col("_level")) & (F.col("cx") == F.col("t.cx")) & (F.col("cy") == F.col("t.cy")), "left_semi"
    ).select("px", "py", "level")
    lowest = seen.unionAll(distinct.select("px", "py", F.lit(TOP))).groupBy("px", "py").agg(F.min("level").alias("level"))
    first = work.put(lowest, "bounds")
    highest = first.agg(F.max("level")).first()[0]

    seen_at = F.col("_seen_at")
    begun = first.withColumnRenamed("level", "_seen_at").withColumns({
        "bound": F.when(seen_at < TOP, _side_of(seen_at) * math.sqrt(8)).otherwise(F.lit(math.inf)),
        "level": F.least(seen_at + 1, F.lit(TOP)),
    })
    own_cells = begun.withColumns({f"_{c}": _above(_cell(F.col(p)), F.col("level")) for c, p in (("x", "px"), ("y", "py"))})
    around = own_cells.withColumn("_around", F.explode(_around(F.col("level"), F.col("_x"), F.col("_y"))))
    state = around.select("px", "py", "bound", "level", "_around.cx", "_around.cy")
    children = tiles.select(
        (F.col("level") + 1).alias("_level"), *[_parent(F.col(t), F.col("level")).alias(n) for t, n in (("tx", "_px"), ("ty", "_py"))], "tx", "ty"
    )
    for _ in range(min((highest or 0) + 1, TOP)):
        state = _descend(state, children)
    return state.where("level = 0").select("px", "py", "cx", "cy")


def nearest_of(points: DataFrame, polygons: DataFrame, id_column: str, work: Staged | None = None) -> DataFrame:
    """Nearest polygon of each distinct point ``px, py``: its id and ``distance``, 0 inside. Equal
    distances take the lowest id; without polygons there are no rows. Few pieces remain for each
    point, however far it is, and only their edges are measured. ``work`` keeps the staged tables.
    """
    cells = nearest_cells(points, polygons, work or Staged(points.sparkSession))
    pieces = _pieces(polygons, F.col(id_column).alias("_id"))
    met = cells.join(pieces, (F.col("cx") == F.col("_cx")) & (F.col("cy") == F.col("_cy")))
    at_home = (_cell(F.col("px")) == F.col("cx")) & (_cell(F.col("py")) == F.col("cy"))
    distance = F.when(at_home & _in_piece(), F.lit(0.0)).otherwise(edge_distance(F.col("_piece.edges"), F.col("px"), F.col("py")))
    measured = met.select("px", "py", distance.alias("distance"), F.col("_id").alias("id")).where("distance is not null")
    best = measured.groupBy("px", "py").agg(F.min(F.struct("distance", "id")).alias("_best"))
    return best.select("px", "py", F.col("_best.id").alias(id_column), F.col("_best.distance").alias("distance"))


def _parent(cell: Column, level: Column) -> Column:
    return F.when(level + 1 >= TOP, F.lit(0)).otherwise(F.call_function("shiftright", cell, F.lit(FAN_BITS))).cast("long")


def _descend(state: DataFrame, children: DataFrame) -> DataFrame:
    """Cells above the lowest level become their occupied parts that can hold the nearest place."""
    same = (F.col("level") == F.col("_level")) & (F.col("cx") == F.col("_px")) & (F.col("cy") == F.col("_py"))
    at_leaf = F.col("level") == 0
    joined = state.join(children, same, "left").where(at_leaf | F.col("tx").isNotNull())
    parts = joined.withColumns({
        "cx": F.when(at_leaf, F.col("cx")).otherwise(F.col("tx")), "cy": F.when(at_leaf, F.col("cy")).otherwise(F.col("ty")),
        "level": F.greatest(F.col("level") - 1, F.lit(0)),
    }).select("px", "py", "bound", "level", "cx", "cy")
    side = _side_of(F.col("level"))
    near, far = F.lit(0.0), F.lit(0.0)
    for point, cell in (("px", "cx"), ("py", "cy")):
        low = F.col(cell) * side + ORIGIN
        high = low + side
        near = near + F.pow(F.greatest(low - F.col(point), F.col(point) - high, F.lit(0.0)), F.lit(2.0))
        far = far + F.pow(F.greatest(F.abs(F.col(point) - low), F.abs(F.col(point) - high)), F.lit(2.0))
    bounded = parts.withColumns({"_near": F.sqrt(near), "_far": F.sqrt(far)}).where(F.col("_near") <= F.col("bound") + SLACK)
    point = Window.partitionBy("px", "py")
    least = bounded.withColumn("bound", F.least("bound", F.min("_far").over(point)))
    return least.where(F.col("_near") <= F.col("bound") + SLACK).drop("_near", "_far")


def place_positions(
    positions: DataFrame, municipalities: DataFrame, districts: DataFrame, work: Staged | None = None
) -> DataFrame:
    """Municipality (containing, else nearest, of the agglomeration) and district of
    distinct positions ``latitude, longitude``."""
    own = municipalities.where(F.col("commune_agglo") == 1).select("code_insee", "pieces")
    located = attach_containing(with_projection(positions), own, ["code_insee"])
    nearest = nearest_of(located.where(F.col("code_insee").isNull()), own, "code_insee", work).select(
        F.col("px").alias("_px"), F.col("py").alias("_py"), F.col("code_insee").alias("_nearest")
    )
    # many positions may share one point outside
    unplaced = F.when(F.col("code_insee").isNull(), F.col("px")).alias("_ux")
    placed = spread_left_join(
        located.select("*", unplaced), nearest, [("_ux", "_px"), ("py", "_py")]
    ).withColumn("code_insee", F.coalesce("code_insee", "_nearest"))
    quarter = districts.select(F.col("nuquart").alias("code_quartier"), "pieces")
    return attach_containing(placed.drop("_ux", "_nearest"), quarter, ["code_quartier"]).select(
        "latitude", "longitude", "code_insee", "code_quartier"
    )


def attribute_places(
    facts: DataFrame, municipalities: DataFrame, districts: DataFrame, positions: DataFrame | None = None,
    work: Staged | None = None,
) -> DataFrame:
    """``facts`` with the municipality and district of their latitude and longitude. Every
    position is placed once; ``positions`` may name a cheaper frame that holds all of
    them. Nothing is sorted; order at the sink."""
    distinct = (facts if positions is None else positions).select("latitude", "longitude").distinct()
    places = place_positions(distinct, municipalities, districts, work).withColumnsRenamed(
        {"latitude": "_latitude", "longitude": "_longitude"}
    )
    on = [("latitude", "_latitude"), ("longitude", "_longitude")]
    return spread_left_join(facts, places, on, null_safe=True, unsorted=True)
