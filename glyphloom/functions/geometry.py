"""Boxes, polygons and relations between them, as column expressions.

A box is a struct x1, y1, x2, y2 of pixels; a polygon an array of alternating x and y. Boxes must
have all four sides: greatest and least pass over nulls. The joins of boxes leave out others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The side of the model's picture and of its patches.
MODEL_SIDE, PATCH = 224, 16


@dataclass(frozen=True)
class Box:
    """The four sides of a box column, so that each is read once."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @staticmethod
    def of(c: Column | str) -> Box:
        c = F.col(c) if isinstance(c, str) else c
        return Box(*(c.getField(f) for f in ("x1", "y1", "x2", "y2")))

    def struct(self) -> Column:
        return F.struct(*(F.coalesce(v).cast("double").alias(n) for v, n in zip((self.x1, self.y1, self.x2, self.y2), ("x1", "y1", "x2", "y2"))))

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def cx(self) -> Column:
        return (self.x1 + self.x2) / 2

    @property
    def cy(self) -> Column:
        return (self.y1 + self.y2) / 2

    @property
    def least_width(self) -> Column:
        """At least a pixel."""
        return F.greatest(self.width, F.lit(1.0))

    @property
    def least_height(self) -> Column:
        return F.greatest(self.height, F.lit(1.0))


def _positive(c: Column, least: float = 1e-6) -> Column:
    return F.greatest(c, F.lit(least))


def from_xywh(b: Column) -> Column:
    """Box of an array x, y, width, height."""
    at = lambda i: F.try_element_at(b, F.lit(i))
    return Box(at(1), at(2), at(1) + at(3), at(2) + at(4)).struct()


def to_xywh(box: Column | str) -> Column:
    b = Box.of(box)
    return F.array(b.x1, b.y1, b.width, b.height)


def to_xywh_clamped(box: Column | str) -> Column:
    """With no negative width or height."""
    b = Box.of(box)
    return F.array(b.x1, b.y1, F.greatest(b.width, F.lit(0.0)), F.greatest(b.height, F.lit(0.0)))


def _every_second(polygon: Column, first: int) -> Column:
    return F.filter(polygon, lambda _, i: i % 2 == first)


def polygon_box(polygon: Column) -> Column:
    xs, ys = _every_second(polygon, 0), _every_second(polygon, 1)
    return Box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)).struct()


def polygon_center(polygon: Column) -> tuple[Column, Column]:
    """Mean of the corners."""
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(v), F.lit(1))
    return mean(_every_second(polygon, 0)), mean(_every_second(polygon, 1))


def box_polygon(box: Column | str) -> Column:
    b = Box.of(box)
    return F.array(b.x1, b.y1, b.x2, b.y1, b.x2, b.y2, b.x1, b.y2)


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def center_distance(a: Box, b: Box) -> Column:
    return distance(a.cx, a.cy, b.cx, b.cy)


def shared_length(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Length that two intervals share."""
    return F.greatest(F.least(a2, b2) - F.greatest(a1, b1), F.lit(0.0))


def shared_area(a: Box, b: Box) -> Column:
    return shared_length(a.x1, a.x2, b.x1, b.x2) * shared_length(a.y1, a.y2, b.y1, b.y2)


def overlap(a: Box, b: Box) -> Column:
    """The share of a's area that lies in b."""
    return shared_area(a, b) / _positive(a.area)


def mutual_overlap(a: Box, b: Box) -> Column:
    """The smaller of the two shares."""
    return shared_area(a, b) / F.greatest(a.area, b.area, F.lit(1e-6))


def iou(a: Box, b: Box) -> Column:
    """Shared area by area of the union."""
    s = shared_area(a, b)
    return F.when(s <= 0, F.lit(0.0)).otherwise(s / _positive(_positive(a.area) + _positive(b.area) - s))


def alike_boxes(a: Box, b: Box) -> Column:
    """The larger of mutual overlap and iou."""
    return F.greatest(mutual_overlap(a, b), iou(a, b))


def point_gap(x: Column, y: Column, b: Box) -> Column:
    """Distance of a point from a box; 0 inside."""
    dx = F.greatest(b.x1 - x, x - b.x2, F.lit(0.0))
    dy = F.greatest(b.y1 - y, y - b.y2, F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def gaps(a: Box, b: Box) -> tuple[Column, Column]:
    """Free space between two boxes along each axis."""
    return F.greatest(b.x1 - a.x2, a.x1 - b.x2, F.lit(0.0)), F.greatest(b.y1 - a.y2, a.y1 - b.y2, F.lit(0.0))


def axis_overlaps(a: Box, b: Box, least: float = 1e-6) -> tuple[Column, Column]:
    """Shared length along each axis by the shorter of the two extents."""
    x = shared_length(a.x1, a.x2, b.x1, b.x2) / _positive(F.least(a.width, b.width), least)
    y = shared_length(a.y1, a.y2, b.y1, b.y2) / _positive(F.least(a.height, b.height), least)
    return x, y


def area_share(b: Box, width: Column, height: Column) -> Column:
    return F.greatest(b.area, F.lit(1.0)) / F.greatest(width.cast("double") * height, F.lit(1.0))


def center_offset(b: Box, width: Column, height: Column) -> Column:
    """How far the centre lies off the picture's, in shares of its sides; half where unknown."""
    off = F.greatest(F.abs(b.cx / F.greatest(width, F.lit(1)) - 0.5), F.abs(b.cy / F.greatest(height, F.lit(1)) - 0.5))
    return F.coalesce(off, F.lit(0.5))


def region(b: Box, width: Column, height: Column) -> Column:
    """Cell of a 3 x 3 grid: u, c or l for the row and l, c or r for the column of the centre."""
    third = lambda v, size, names: F.when(v < size / 3, names[0]).when(v < 2 * size / 3, names[1]).otherwise(names[2])
    return F.concat(third(b.cy, height, "ucl"), third(b.cx, width, "lcr"))


def fine_cell(b: Box, width: Column, height: Column, parts: int = 6) -> Column:
    """Row and column of the centre in a grid of parts x parts; empty where the picture's size is unknown."""
    at = lambda v, size: F.greatest(F.least(F.floor(v * parts / size), F.lit(parts - 1)), F.lit(0))
    return F.when((width > 0) & (height > 0), F.concat_ws("-", at(b.cy, height), at(b.cx, width))).otherwise("")


def bucket_name(x: Column, y: Column) -> Column:
    """Name of the cell in which a point lies, given in shares of the sides."""
    part = lambda v, names: F.when(v < 0.34, names[0]).when(v <= 0.66, names[1]).otherwise(names[2])
    return F.concat(part(y, ("upper", "middle", "lower")), F.lit("_"), part(x, ("left", "center", "right")))


def expanded(b: Box, width: Column, height: Column, scale: float = 2.5) -> Column:
    """Scaled about the centre, at least 8 pixels to each side, in whole pixels within the picture."""
    half = lambda v: F.greatest(v * (scale / 2), F.lit(8.0))
    hw, hh = half(b.width), half(b.height)
    low = lambda v: F.greatest(F.floor(v), F.lit(0))
    return Box(low(b.cx - hw), low(b.cy - hh), F.least(F.ceil(b.cx + hw), width), F.least(F.ceil(b.cy + hh), height)).struct()


def moved(inner: Box, frame: Box) -> Column:
    """A box inside a crop, in the picture's pixels."""
    return Box(*(F.bround(v + o, 2) for v, o in ((inner.x1, frame.x1), (inner.y1, frame.y1), (inner.x2, frame.x1), (inner.y2, frame.y1)))).struct()


def _ordered(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return Box(F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2)).struct()


def from_thousandths(b: Column, width: Column, height: Column) -> Column:
    """Box of an array in thousandths of the sides: rounded, kept within the picture, sides in order."""
    at = lambda i, size: F.greatest(F.least(F.bround(F.try_element_at(b, F.lit(i)) * size / 1000, 2), size - 1), F.lit(0.0))
    return _ordered(at(1, width), at(2, height), at(3, width), at(4, height))


def from_relative(b: Column, width: Column, height: Column) -> Column:
    """The same, where the array may also be in shares of the sides: then no value exceeds 1."""
    whole = F.transform(b, lambda v: v * 1000)
    return F.when(F.array_max(b) <= 1, from_thousandths(whole, width, height)).otherwise(from_thousandths(b, width, height))


def resolvability(box: Column | str, width: Column, height: Column, patches: tuple[float, float] = (1.75, 0.7)) -> Column:
    """How large a text is in the model's picture, and whether it reaches the given patches."""
    b = Box.of(box)
    px = lambda v, size: F.greatest(v / F.greatest(size, F.lit(1)), F.lit(0.0)) * MODEL_SIDE
    w, h = px(b.width, width), px(b.height, height)
    least = [p * PATCH for p in patches]
    names = ("text_px_w", "text_px_h", "min_width_px", "min_height_px", "min_width_patches", "min_height_patches")
    values = [v.cast("double").alias(n) for v, n in zip((w, h, *map(F.lit, least), *map(F.lit, patches)), names)]
    return F.struct(*values, ((w >= least[0]) & (h >= least[1])).alias("passes"))


def grid_boxes(width: Column, height: Column) -> Column:
    """array<struct<region_key, box>>: the nine cells of the picture, row by row."""
    cells = []
    for r, row in enumerate("ucl"):
        for c, column in enumerate("lcr"):
            sides = (width / 3 * c, height / 3 * r, width / 3 * (c + 1), height / 3 * (r + 1))
            cells.append(F.struct(F.lit(row + column).alias("region_key"), Box(*sides).struct().alias("box")))
    return F.array(*cells)


def snapped(c: Column) -> Column:
    """Nine decimals. Cut off the ties, which decimals of pixels hit, so that a last bit can't matter."""
    return F.floor(c * 1e9 + 0.3) / 1e9


# Relations


def direction(a: Box, b: Box, width: Column, height: Column) -> Column:
    """Where b lies from a: overlapping, or the side of the axis along which the centres differ more."""
    dx, dy = b.cx - a.cx, b.cy - a.cy
    across = F.when(dx > 0, "right_of").otherwise("left_of")
    down = F.when(dy > 0, "below").otherwise("above")
    tie = F.when(F.abs(dx) >= 0.05 * width, across).when(F.abs(dy) >= 0.05 * height, down).otherwise("overlapping")
    on = F.greatest(overlap(a, b), overlap(b, a)) > 0.05
    return F.when(on, "overlapping").when(F.abs(dx) > F.abs(dy), across).when(F.abs(dy) > F.abs(dx), down).otherwise(tie)


def relation(text: Box, anchor: Box, width: Column, height: Column) -> Column:
    """on, above, below, left_of or right_of for a text and its anchor; null if they have none."""
    x_share, y_share = axis_overlaps(text, anchor)
    gap_x, gap_y = gaps(text, anchor)
    areas = _positive(text.area), _positive(anchor.area)
    far = F.greatest(*areas) / F.least(*areas) > 5
    stacked = (x_share >= 0.2) & (gap_y <= 0.2 * height)
    beside = (y_share >= 0.2) & (gap_x <= 0.3 * width)
    sides = (("above", stacked & (text.cy < anchor.cy)), ("below", stacked & (text.cy > anchor.cy)), ("left_of", beside & (text.cx < anchor.cx)), ("right_of", beside & (text.cx > anchor.cx)))
    out = F.when(overlap(text, anchor) >= 0.35, "on").when(far, F.lit(None).cast("string"))
    for name, holds in sides:
        out = out.when(holds, name)
    return out


def relevance(text: Box, center: tuple[Column, Column], anchor: Box, width: Column, height: Column) -> Column:
    """How well an anchor serves a text: overlap, nearness and fitting size, less for too large ones.

    center: the mean of the corners of the text's polygon."""
    x, y = center
    one = lambda v: F.greatest(v, F.lit(1.0))
    s = shared_area(text, anchor)
    t_area, a_area = one(text.area), one(anchor.area)
    near = F.greatest(1 - point_gap(x, y, anchor) / one(F.greatest(width, height).cast("double")), F.lit(0.0))
    ratio, share = a_area / t_area, a_area / one(width.cast("double") * height)
    inside = x.between(anchor.x1, anchor.x2) & y.between(anchor.y1, anchor.y2)
    fit = F.when(inside & ratio.between(1.5, 80.0), 0.22).when(inside & (ratio <= 140), 0.10).otherwise(0.0)
    large = F.when(share > 0.55, F.least(F.lit(0.85), (share - 0.55) * 1.7)).otherwise(0.0)
    huge = F.when(ratio > 140, F.least(F.lit(0.75), F.ln(ratio / 140 + 1) * 0.45)).otherwise(0.0)
    value = overlap(text, anchor) * 0.32 + s / one(t_area + a_area - s) * 0.28 + near * 0.18 + fit - large - huge
    return F.greatest(value, F.lit(0.0))


def connected(a: Box, b: Box, width: Column, height: Column) -> Column:
    """Whether two texts belong to one group: they touch, stand in a line or column, or are near."""
    gap_x, gap_y = gaps(a, b)
    x_share, y_share = axis_overlaps(a, b)
    high = F.greatest(a.least_height, b.least_height)
    span = F.greatest(a.least_width, a.least_height, b.least_width, b.least_height)
    near = center_distance(a, b) <= F.greatest(F.lit(40.0), F.greatest(width, height) * 0.11, span * 2.4)
    touch = F.greatest(overlap(a, b), overlap(b, a)) >= 0.05
    return touch | ((y_share >= 0.3) & (gap_x <= 2.2 * high)) | ((x_share >= 0.3) & (gap_y <= 2.2 * high)) | near


def supports(a: Box, b: Box) -> Column:
    """Whether two candidate boxes speak for the same thing."""
    diagonal = F.greatest(F.hypot(a.width, a.height), F.hypot(b.width, b.height), F.lit(1.0))
    return (F.greatest(overlap(a, b), overlap(b, a)) >= 0.35) | (center_distance(a, b) <= 0.22 * diagonal)


def styles_fit(height_a: Column, height_b: Column, kinds: tuple[Column, Column], cases: tuple[Column, Column], most: float) -> Column:
    """Whether two texts may be parts of one: like heights, numbers only with numbers, one case."""
    tall = F.greatest(height_a, height_b) / F.greatest(F.least(height_a, height_b), F.lit(1.0)) <= most
    (ka, kb), (ca, cb) = kinds, cases
    number = ((ka == "numeric") | (kb == "numeric")) & (ka != kb)
    case = (ka == "alpha") & (kb == "alpha") & (ca != cb) & (ca != "mixed") & (cb != "mixed")
    return tall & ~number & ~case


def joins_inline(a: Box, b: Box, y_least: float, gap_most: float) -> Column:
    """Whether b continues a on the line, apart from style."""
    high = F.greatest(a.least_height, b.least_height)
    share = shared_length(a.y1, a.y2, b.y1, b.y2) / F.least(a.least_height, b.least_height)
    return (share >= y_least) & (b.x1 - a.x2).between(-0.2 * high, gap_most * high)


def joins_stacked(a: Box, b: Box, x_least: float, gap_most: float) -> Column:
    """Whether b stands under a, apart from style."""
    high = F.greatest(a.least_height, b.least_height)
    share = shared_length(a.x1, a.x2, b.x1, b.x2) / F.least(a.least_width, b.least_width)
    return (share >= x_least) & (b.y1 - a.y2).between(-0.2 * high, gap_most * high)


def in_cluster(node: Box, cluster: Box, least: float) -> Column:
    """Whether a node belongs to a cluster's box: its centre is inside or they overlap enough."""
    inside = node.cx.between(cluster.x1, cluster.x2) & node.cy.between(cluster.y1, cluster.y2)
    return inside | (F.greatest(overlap(node, cluster), overlap(cluster, node), iou(node, cluster)) >= least)


def viable_anchor(anchor: Box, text: Box, generic: Column, width: Column, height: Column) -> Column:
    """Whether an anchor is small enough to tell where a text is; generic labels must be smaller."""
    share = area_share(anchor, width, height)
    ratio = F.greatest(anchor.area, F.lit(1.0)) / F.greatest(text.area, F.lit(1.0))
    return (share <= 0.94) & (~generic | ((share <= 0.70) & (ratio <= 220)))


def orientation(x_range: Column, y_range: Column, n: Column) -> Column:
    """singleton, vertical, horizontal or mixed, of the ranges of n centres."""
    return F.when(n <= 1, "singleton").when(y_range > x_range * 1.35, "vertical").when(x_range > y_range * 1.35, "horizontal").otherwise("mixed")
