"""Column expressions on rings: closed arrays of struct<x, y>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
EMPTY = f"cast(array() as array<{POINT}>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def point(x, y) -> Column:
    return F.struct(F.lit(x).cast("double").alias("x") if not isinstance(x, Column) else x.cast("double").alias("x"), F.lit(y).cast("double").alias("y") if not isinstance(y, Column) else y.cast("double").alias("y"))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def edges(ring: Column) -> Column:
    """array<struct<p, q>> of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, v: a + v)


def _cross(e: Column) -> Column:
    return e.p.x * e.q.y - e.q.x * e.p.y


def signed_area(ring: Column) -> Column:
    """Positive for counter-clockwise rings; computed about the first point, so large coordinates lose nothing."""
    return let(ring, lambda r: let(F.get(r, F.lit(0)), lambda o: _sum(F.transform(edges(r), lambda e: (e.p.x - o.x) * (e.q.y - o.y) - (e.q.x - o.x) * (e.p.y - o.y))) / 2))


def ring_area(ring: Column) -> Column:
    """Shoelace area; an empty ring has area 0."""
    return let(ring, lambda r: F.when(F.size(r) > 3, F.abs(signed_area(r))).when(r.isNotNull(), F.lit(0.0)))


def ring_centroid(ring: Column) -> Column:
    """Centroid as struct<x, y>; null for rings without area."""
    def of(r: Column) -> Column:
        o = F.get(r, F.lit(0))
        local = F.transform(r, lambda p: F.struct((p.x - o.x).alias("x"), (p.y - o.y).alias("y")))
        parts = F.transform(edges(local), lambda e: F.struct(((e.p.x + e.q.x) * _cross(e)).alias("x"), ((e.p.y + e.q.y) * _cross(e)).alias("y"), _cross(e).alias("a")))
        sums = F.aggregate(parts, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("a")), lambda s, v: F.struct((s.x + v.x).alias("x"), (s.y + v.y).alias("y"), (s.a + v.a).alias("a")))
        return let(sums, lambda s: F.when(s.a != 0, F.struct((o.x + s.x / (3 * s.a)).alias("x"), (o.y + s.y / (3 * s.a)).alias("y"))))

    return let(ring, of)


def ring_bbox(ring: Column, margin: float = 0.0, width: float | None = None, height: float | None = None) -> Column:
    """struct<x0, y0, x1, y1> with a margin, clamped to the image where its size is given."""
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    x0, y0, x1, y1 = F.array_min(xs) - margin, F.array_min(ys) - margin, F.array_max(xs) + margin, F.array_max(ys) + margin
    if width is not None:
        x0, x1 = F.greatest(x0, F.lit(0.0)), F.least(x1, F.lit(float(width)))
    if height is not None:
        y0, y1 = F.greatest(y0, F.lit(0.0)), F.least(y1, F.lit(float(height)))
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def _clip_half(ring: Column, side: Callable[[Column], Column]) -> Column:
    """Keep the part of a ring where side(point) >= 0."""
    def cut(e: Column) -> Column:
        a, b = side(e.p), side(e.q)
        t = a / (a - b)
        meet = point(e.p.x + t * (e.q.x - e.p.x), e.p.y + t * (e.q.y - e.p.y))
        return (
            F.when((a >= 0) & (b >= 0), F.array(e.q)).when((a >= 0) & (b < 0), F.array(meet)).when((a < 0) & (b >= 0), F.array(meet, e.q)).otherwise(F.expr(EMPTY))
        )

    return let(F.flatten(F.transform(edges(ring), cut)), lambda r: F.concat(r, F.slice(r, 1, 1)))


def clip_to_box(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Ring of the intersection with an axis-parallel box; empty if they do not meet. Right in area for any simple ring."""
    r = let(ring, lambda r: _clip_half(r, lambda p: p.x - x0))
    r = let(r, lambda r: _clip_half(r, lambda p: x1 - p.x))
    r = let(r, lambda r: _clip_half(r, lambda p: p.y - y0))
    return let(r, lambda r: _clip_half(r, lambda p: y1 - p.y))


def box_overlap_area(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area of a simple ring's intersection with an axis-parallel box, in one pass over the edges.

    It is the integral over y in the box of the length of the ring inside [x0, x1], a signed sum over edges of clamp(x, x0, x1) - x0,
    whose antiderivative in x is known.
    """
    clamp = lambda v, lo, hi: F.greatest(lo, F.least(v, hi))
    wide = x1 - x0

    def integral(x: Column) -> Column:
        return F.when(x <= x0, F.lit(0.0)).when(x >= x1, wide * wide / 2 + wide * (x - x1)).otherwise((x - x0) * (x - x0) / 2)

    def of(e: Column) -> Column:
        dx, dy = e.q.x - e.p.x, e.q.y - e.p.y
        ya, yb = clamp(e.p.y, y0, y1), clamp(e.q.y, y0, y1)
        ends = F.struct((e.p.x + (ya - e.p.y) / dy * dx).alias("a"), (e.p.x + (yb - e.p.y) / dy * dx).alias("b"), (yb - ya).alias("h"))
        mean = lambda s: F.when(F.abs(s.b - s.a) > 1e-6 * wide, (integral(s.b) - integral(s.a)) / (s.b - s.a)).otherwise(clamp((s.a + s.b) / 2, x0, x1) - x0)
        return F.when(dy != 0, let(ends, lambda s: s.h * mean(s))).otherwise(0.0)

    return F.abs(_sum(F.transform(edges(ring), of)))


def clip_to_convex(ring: Column, convex: Column) -> Column:
    """Ring of the intersection with a convex ring, by one half-plane for each of its edges."""
    oriented = let(convex, lambda c: F.when(signed_area(c) < 0, F.reverse(c)).otherwise(c))
    return F.aggregate(edges(oriented), ring, lambda r, e: _clip_half(r, lambda p: (e.q.x - e.p.x) * (p.y - e.p.y) - (e.q.y - e.p.y) * (p.x - e.p.x)))


def polygon_dice(a: Column, convex: Column) -> Column:
    both = ring_area(clip_to_convex(a, convex))
    return 2 * both / (ring_area(a) + ring_area(convex))


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Crossing number test; points on the boundary are outside."""
    on = F.exists(edges(ring), lambda e: (((e.q.x - e.p.x) * (y - e.p.y) - (e.q.y - e.p.y) * (x - e.p.x)) == 0) & x.between(F.least(e.p.x, e.q.x), F.greatest(e.p.x, e.q.x)) & y.between(F.least(e.p.y, e.q.y), F.greatest(e.p.y, e.q.y)))
    crossed = F.filter(edges(ring), lambda e: ((e.p.y > y) != (e.q.y > y)) & (x < e.p.x + (y - e.p.y) * (e.q.x - e.p.x) / (e.q.y - e.p.y)))
    return (F.size(crossed) % 2 == 1) & ~on


def in_convex(x: Column, y: Column, hull: Column) -> Column:
    """Inside or on a counter-clockwise convex ring."""
    return F.forall(edges(hull), lambda e: (e.q.x - e.p.x) * (y - e.p.y) - (e.q.y - e.p.y) * (x - e.p.x) >= 0)


def distance_to_ring(x: Column, y: Column, ring: Column) -> Column:
    def to(e: Column) -> Column:
        dx, dy = e.q.x - e.p.x, e.q.y - e.p.y
        t = F.when(dx * dx + dy * dy > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e.p.x) * dx + (y - e.p.y) * dy) / (dx * dx + dy * dy)))).otherwise(0.0)
        return F.sqrt(F.pow(x - e.p.x - t * dx, F.lit(2.0)) + F.pow(y - e.p.y - t * dy, F.lit(2.0)))

    return F.array_min(F.transform(edges(ring), to))


def near_edge(x: Column, y: Column, ring: Column, d: float) -> Column:
    """Inside the ring and at most d from its edge."""
    return point_in_ring(x, y, ring) & (distance_to_ring(x, y, ring) <= d)


def scale_ring(ring: Column, k: float) -> Column:
    return F.transform(ring, lambda p: point(p.x * k, p.y * k))


def transform_ring(ring: Column, m: Column) -> Column:
    """Apply an affine struct<a, b, c, d, tx, ty>: x' = a x + b y + tx, y' = c x + d y + ty."""
    return F.transform(ring, lambda p: point(m.a * p.x + m.b * p.y + m.tx, m.c * p.x + m.d * p.y + m.ty))


def ring_in_range(ring: Column, width: float, height: float, tol: float = 0.0) -> Column:
    return F.forall(ring, lambda p: p.x.between(-tol, width + tol) & p.y.between(-tol, height + tol))


def quad_rotation(ring: Column, base_deg: float = 0.0) -> Column:
    """Mean deviation of a quadrangle's four edges from the nearest axis, plus a base rotation, in degrees."""
    turn = F.transform(edges(ring), lambda e: F.degrees(F.atan2(e.q.y - e.p.y, e.q.x - e.p.x)))
    off = F.transform(turn, lambda t: t - F.round(t / 90) * 90)
    return _sum(off) / F.size(off) + base_deg


def corner_labels(ring: Column) -> Column:
    """For each point of a quadrangle: left or right and top or bottom of the middle of its box (y grows downwards)."""
    return let(ring_bbox(ring), lambda b: F.transform(F.slice(ring, 1, F.size(ring) - 1), lambda p: F.struct(F.concat(F.when(p.y < (b.y0 + b.y1) / 2, "top").otherwise("bottom"), F.when(p.x < (b.x0 + b.x1) / 2, "left").otherwise("right")).alias("corner"), p.x.alias("x"), p.y.alias("y"))))


CORNERS = ("topleft", "topright", "bottomright", "bottomleft")


def pair_corners(ring: Column, other: Column) -> Column:
    """array<struct<corner, x, y, other_x, other_y>>: the corners of two quadrangles (closed rings) paired by their labels, in the order of CORNERS. Of several points
    with one label that of smallest x + y counts, then of smallest x; null unless all four labels occur in both rings (a quadrangle that stands on a corner has none)."""
    def first(labelled: Column, corner: str) -> Column:
        here = F.filter(labelled, lambda p: p.corner == corner)
        return F.get(F.array_sort(F.transform(here, lambda p: F.struct((p.x + p.y).alias("s"), p.x.alias("x"), p.y.alias("y")))), F.lit(0))

    def four(r: Column) -> Column:
        return let(corner_labels(r), lambda labelled: F.array(*[first(labelled, c) for c in CORNERS]))

    def paired(both: Column) -> Column:
        pairs = [F.struct(F.lit(c).alias("corner"), both.a[i].x.alias("x"), both.a[i].y.alias("y"), both.b[i].x.alias("other_x"), both.b[i].y.alias("other_y")) for i, c in enumerate(CORNERS)]
        return F.when(F.forall(both.a, lambda p: p.isNotNull()) & F.forall(both.b, lambda p: p.isNotNull()), F.array(*pairs))

    return let(F.struct(four(ring).alias("a"), four(other).alias("b")), paired)


def top_left(ring: Column) -> Column:
    return F.get(F.array_sort(F.transform(ring, lambda p: F.struct((p.x + p.y).alias("s"), p.x.alias("x"), p.y.alias("y")))), F.lit(0))
