"""Exact nearest neighbours without a radius: a pyramid of cell counts bounds how far each point has to look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.operators.lineage import cut

CROWD = 256  # points of a cell, for each neighbour sought, up to which the finest cells are fine enough
MOST_LEVELS = 62  # a cell of the coarsest level is 2**62 finest ones wide


def placed(df: DataFrame) -> DataFrame:
    """The points that have a place: x and y neither null nor NaN nor infinite."""
    ok = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < 1e300) for c in ("x", "y")]
    return df.where(ok[0] & ok[1])


def _cell(v: Column, side: float) -> Column:
    return F.floor(v / side).cast("long")


def _gaps(level: Column) -> tuple[Column, Column]:
    """(nearest, farthest) squared distance, in finest sides, of any two points of the unit's finest cell (_ux, _uy) and of a cell (_cx, _cy) of the level."""
    wide = F.pow(F.lit(2.0), level)
    near, far = [], []
    for u, c in (("_ux", "_cx"), ("_uy", "_cy")):
        lo, hi = F.col(c) * wide, (F.col(c) + 1) * wide
        own = F.col(u).cast("double")
        near.append(F.greatest(F.lit(0.0), lo - own - 1, own - hi))
        far.append(F.greatest(hi - own, own + 1 - lo))
    return near[0] * near[0] + near[1] * near[1], far[0] * far[0] + far[1] * far[1]


def nearest(a: DataFrame, b: DataFrame, k: int, keys: list[str], side: float = 1.0) -> DataFrame:
    """(keys, id, other, d): for each point of a (keys, id, x, y) the min(k, n) nearest of the n points of b in its group, ties by the smaller id; more
    candidates may come with them, so the caller ranks. Points without a place (null, NaN or infinite x or y) find nothing and are not found.

    Of points of b at one place only the k smallest ids can count. Cells of the finest level are halved until none is crowded, at most eight times. All points of a in
    one finest cell look together (a unit). A unit starts at the smallest cell around it that holds k points of b and goes down the pyramid: of the
    cells that it still looks at, those whose farthest points are nearest and that hold k points together bound the radius; cells whose nearest point is farther go,
    the others are replaced by their children. So rounds are at most the levels of the pyramid, a unit looks at few cells a level, and points only meet in the
    last join. An outlier climbs to a large cell but does not meet the points in it.
    """
    keys = list(keys)
    a = placed(a.select(*keys, "id", "x", "y"))
    b = placed(b.select(*keys, F.col("id").alias("other"), F.col("x").alias("_x"), F.col("y").alias("_y"), "x", "y")).drop("x", "y")
    same = Window.partitionBy(*keys, "_x", "_y").orderBy("other")
    b = cut(b.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k).drop("_n"))
    for _ in range(8):
        crowd = b.groupBy(*keys, _cell(F.col("_x"), side).alias("_cx"), _cell(F.col("_y"), side).alias("_cy")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if crowd <= CROWD * k:
            break
        side /= 2 ** max(1, ((crowd // (CROWD * k)).bit_length() + 1) // 2)
    b = b.withColumn("_cx", _cell(F.col("_x"), side)).withColumn("_cy", _cell(F.col("_y"), side))
    a = a.withColumn("_ux", _cell(F.col("x"), side)).withColumn("_uy", _cell(F.col("y"), side))

    # The pyramid: counts of b by cell and level, up to a level at which every group is within two cells by two.
    levels = [b.groupBy(*keys, "_cx", "_cy").agg(F.count("*").alias("n")).withColumn("level", F.lit(0))]
    levels[0] = cut(levels[0])
    span = levels[0].groupBy(*keys).agg(F.greatest(F.max("_cx") - F.min("_cx"), F.max("_cy") - F.min("_cy")).alias("s")).agg(F.max("s")).first()[0]
    if span is None:
        return a.crossJoin(b.drop(*keys).limit(0)).select(*keys, "id", "other", F.lit(0.0).alias("d"))  # b is empty, and so is this
    for level in range(1, min(MOST_LEVELS, int(span).bit_length() + 1) + 1):
        up = levels[-1].groupBy(*keys, F.shiftright("_cx", 1).alias("_cx"), F.shiftright("_cy", 1).alias("_cy")).agg(F.sum("n").alias("n")).withColumn("level", F.lit(level))
        levels.append(cut(up))
    pyramid = levels[0]
    for x in levels[1:]:
        pyramid = pyramid.unionByName(x)
    top = len(levels) - 1

    need = levels[-1].groupBy(*keys).agg(F.least(F.sum("n"), F.lit(k)).alias("_need"))
    units = a.select(*keys, "_ux", "_uy").distinct()
    units = units.join(need, keys) if keys else units.crossJoin(F.broadcast(need))  # one row
    unit = [*keys, "_ux", "_uy"]
    climb = units.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumn("_cx", F.expr("shiftright(_ux, level)")).withColumn("_cy", F.expr("shiftright(_uy, level)"))
    enough = climb.join(pyramid, [*keys, "level", "_cx", "_cy"]).where("n >= _need").groupBy(*unit).agg(F.min("level").alias("_start"))
    # Units near which no cell of the pyramid holds enough look at all cells of the top level, of which a group has few.
    begun = units.join(enough, unit, "left").withColumn("_start", F.coalesce("_start", F.lit(top)))
    # What may hold the nearest: cells of the level within the unit's cell's diagonal, so two cells away at most; at the top every cell.
    around = F.explode(F.sequence(F.lit(-2), F.lit(2)))
    low = begun.where(F.col("_start") < top).withColumn("_i", around).withColumn("_j", F.explode(F.sequence(F.lit(-2), F.lit(2))))
    low = low.select(*unit, "_need", F.col("_start").alias("level"), (F.expr("shiftright(_ux, _start)") + F.col("_i")).alias("_cx"), (F.expr("shiftright(_uy, _start)") + F.col("_j")).alias("_cy"))
    high = begun.where(F.col("_start") == top).select(*unit, "_need")
    cells = levels[-1].select(*keys, "level", "_cx", "_cy", "n")  # at most three by three a group
    high = high.join(cells, keys) if keys else high.crossJoin(F.broadcast(cells))
    front = cut(low.join(pyramid, [*keys, "level", "_cx", "_cy"]).select(*unit, "_need", "level", "_cx", "_cy", "n").unionByName(high.select(*unit, "_need", "level", "_cx", "_cy", "n")))

    def pruned(front: DataFrame) -> DataFrame:
        """Without the cells that are farther than the radius within which the nearest cells hold enough."""
        near, far = _gaps(F.col("level").cast("double"))
        mine = Window.partitionBy(*unit)
        seen = F.sum("n").over(mine.orderBy("_far", "_cx", "_cy", "level").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        held = front.withColumn("_near", near).withColumn("_far", far).withColumn("_seen", seen)
        bound = F.min(F.when(F.col("_seen") >= F.col("_need"), F.col("_far"))).over(mine)
        return held.withColumn("_bound", bound).where(F.col("_near") <= F.col("_bound") * (1 + 1e-9) + 1e-9).drop("_near", "_far", "_seen", "_bound")

    while True:
        front = cut(pruned(front))
        level = int(front.agg(F.max("level")).first()[0] or 0)
        if level == 0:
            break
        # Cells of the coarsest level present go down; finer ones wait.
        kids = front.where(F.col("level") == level)
        both = F.explode(F.array(F.lit(0), F.lit(1)))
        kids = kids.withColumn("_i", both).withColumn("_j", F.explode(F.array(F.lit(0), F.lit(1))))
        kids = kids.select(*unit, "_need", F.lit(level - 1).alias("level"), (F.shiftleft("_cx", 1) + F.col("_i")).alias("_cx"), (F.shiftleft("_cy", 1) + F.col("_j")).alias("_cy"))
        kids = kids.join(levels[level - 1], [*keys, "level", "_cx", "_cy"]).select(front.columns)
        front = front.where(F.col("level") < level).unionByName(kids)
    met = front.select(*unit, "_cx", "_cy").join(a, unit).join(b, [*keys, "_cx", "_cy"])
    return met.select(*keys, "id", "other", F.hypot(F.col("x") - F.col("_x"), F.col("y") - F.col("_y")).alias("d"))
