"""Joins of boxes within images, nearest neighbours, support, and groups of texts.

Boxes meet through a grid: each is listed under the cells it covers, boxes of one image and cell
are compared, and a pair counts in the one cell that holds the corner of their shared part. So no
image, however many boxes it has, has all its pairs formed, and no distinct is needed. Reaching
predicates first enlarge the boxes by their reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphloom.functions import geometry as G
from glyphloom.functions.geometry import Box
from glyphloom.operators import anchoring
from glyphloom.operators.graph import components
from glyphloom.operators.skew import lookup_join, with_counts
from glyphloom.session import written

#: Pixels of a grid cell's side, for boxes themselves and for those enlarged by far reaches: about
#: as large as what it holds, so a box covers few cells and a cell holds few boxes.
CELL, REACH_CELL = 256, 512
#: Pixels between the points of the lattice that ties boxes, and so many of a box are looked at.
POINT, MOST_POINTS = 64, 4096
#: So many cells with boxes that aren't tied yet are met by broadcast.
MIXED_CELLS = 20_000
#: Texts of an image that are all compared with each other at once.
SMALL_IMAGE = 100


def _cells(df: DataFrame, frame: Column, cell: int) -> DataFrame:
    """df with its frame (a box struct) and a row for every cell that covers."""
    at = lambda v: F.floor(v / cell)
    b = Box.of(frame)
    rows = df.withColumn("_f", frame)
    x = F.explode(F.sequence(at(b.x1), F.greatest(at(b.x1), at(b.x2)))).alias("_cx")
    y = F.explode(F.sequence(at(Box.of("_f").y1), F.greatest(at(Box.of("_f").y1), at(Box.of("_f").y2)))).alias("_cy")
    return rows.where("_f is not null and _f.x1 <= _f.x2 and _f.y1 <= _f.y2").select("*", x).select("*", y)


def near_pairs(left: DataFrame, right: DataFrame, left_box: str = "box", right_box: str = "box", left_frame: Callable[[Column], Column] | None = None, right_frame: Callable[[Column], Column] | None = None, on: tuple[str, ...] = ("image_id",), cell: int = CELL) -> DataFrame:
    """Pairs of rows of one image whose frames (the boxes themselves, if not given) touch.

    Columns of the two sides come as structs l and r. Boxes with a null or turned side pair with
    nothing."""
    a = _cells(left.select(*on, F.struct(*left.columns).alias("l")), (left_frame or (lambda c: c))(F.col("l")[left_box]), cell).withColumnRenamed("_f", "_lf")
    b = _cells(right.select(*on, F.struct(*right.columns).alias("r")), (right_frame or (lambda c: c))(F.col("r")[right_box]), cell).withColumnRenamed("_f", "_rf")
    joined = a.join(b, [*on, "_cx", "_cy"])
    x, y = F.greatest("_lf.x1", "_rf.x1"), F.greatest("_lf.y1", "_rf.y1")
    touch = (x <= F.least("_lf.x2", "_rf.x2")) & (y <= F.least("_lf.y2", "_rf.y2"))
    home = (F.floor(x / cell) == F.col("_cx")) & (F.floor(y / cell) == F.col("_cy"))
    return joined.where(touch & home).select(*on, "l", "r")


def strangers(rows: DataFrame, root: str, frame: str, scope: str = "image_id", cell: int = CELL) -> DataFrame:
    """Pairs (l, r) of rows of one scope whose frames touch and whose roots differ, some twice.

    rows should be a written table. Cells whose rows all have one root are left out; in the others each
    row meets those that haven't the cell's most frequent root. So where nearly all is tied already,
    few pairs are formed, however many rows a cell has."""
    key = [scope, "_cx", "_cy"]
    packed = _cells(rows.select(scope, F.col(root).alias("_root"), F.struct(*rows.columns).alias("_row")), F.col("_row")[frame], cell)
    counts = packed.groupBy(*key, "_root").agg(F.count(F.lit(1)).alias("_n"))
    mixed = counts.groupBy(*key).agg(F.max_by("_root", F.struct("_n", "_root")).alias("_most"), F.count(F.lit(1)).alias("_roots")).where("_roots > 1").drop("_roots")
    mixed = F.broadcast(few) if (few := written(mixed, "mixed")).count() <= MIXED_CELLS else few
    side = lambda d, n: d.select(*key, F.col("_root").alias(f"_{n}root"), F.col("_row").alias(n), F.col("_f").alias(f"_{n}f"))
    both = packed.join(mixed, key)
    joined = side(both, "l").join(side(both.where("_root <> _most"), "r"), key).where("_lroot <> _rroot")
    x, y = F.greatest("_lf.x1", "_rf.x1"), F.greatest("_lf.y1", "_rf.y1")
    touch = (x <= F.least("_lf.x2", "_rf.x2")) & (y <= F.least("_lf.y2", "_rf.y2"))
    return joined.where(touch & (F.floor(x / cell) == F.col("_cx")) & (F.floor(y / cell) == F.col("_cy"))).select("l", "r")


def joined_roots(rows: DataFrame, root: str, edges: DataFrame) -> DataFrame:
    """rows with the roots that edges (a, b) of roots tie made one."""
    tied = components(edges).select(F.col("node").alias(root), F.col("root").alias("_tied"))
    return lookup_join(rows, tied, [root], "left").withColumn(root, F.coalesce("_tied", root)).drop("_tied")


def touching(rows: DataFrame, name: str, scope: str, box: str = "box") -> DataFrame:
    """rows with _root, a string that those share whose boxes touch, directly or through others of the
    scope. name: a string column, unique over all scopes.

    Boxes on one point of a lattice touch: these are tied without pairs, then what is left apart."""
    b = Box.of(box)
    low, high = lambda v: F.ceil(v / POINT), lambda v: F.floor(v / POINT)
    points = (F.greatest(high(b.x2) - low(b.x1) + 1, F.lit(0)) * F.greatest(high(b.y2) - low(b.y1) + 1, F.lit(0))).between(1, MOST_POINTS)
    at = lambda x, y: F.concat_ws("\u0002", scope, x, y)
    covered = rows.where(points).select(scope, low(b.x1).alias("x1"), low(b.y1).alias("y1"), high(b.x2).alias("x2"), high(b.y2).alias("y2"))
    lattice = covered.select("*", F.explode(F.sequence("x1", "x2")).alias("x")).select("*", F.explode(F.sequence("y1", "y2")).alias("y"))
    lattice = lattice.groupBy(scope, "x", "y").agg(F.max(F.col("x") < F.col("x2")).alias("right"), F.max(F.col("y") < F.col("y2")).alias("down"))
    lattice = written(lattice, "lattice")
    edge = lambda which, x, y: lattice.where(which).select(at("x", "y").alias("a"), at(x, y).alias("b"))
    first = rows.withColumn("_root", F.when(points, at(low(b.x1), low(b.y1))).otherwise(F.col(name)))
    tied = written(joined_roots(first, "_root", edge("right", F.col("x") + 1, F.col("y")).unionByName(edge("down", F.col("x"), F.col("y") + 1))), "tied")
    pairs = strangers(tied, "_root", box, scope)
    return joined_roots(tied, "_root", pairs.select(F.col("l._root").alias("a"), F.col("r._root").alias("b")))


def overlapping_pairs(nodes: DataFrame, key: str, least: float, measure: Callable[[Box, Box], Column] = G.iou) -> DataFrame:
    """(image_id, a, b, value): unordered pairs of an image's boxes with at least that measure."""
    narrow = nodes.select("image_id", key, "box")
    pairs = near_pairs(narrow, narrow).where(F.col(f"l.{key}") < F.col(f"r.{key}"))
    value = measure(Box.of("l.box"), Box.of("r.box"))
    return pairs.select("image_id", F.col(f"l.{key}").alias("a"), F.col(f"r.{key}").alias("b"), value.alias("value")).where(F.col("value") >= least)


def _reach(box: Column, width: Column, height: Column) -> Column:
    """The box enlarged by how far a text may be from another of its group."""
    b = Box.of(box)
    r = F.greatest(F.lit(40.0), F.greatest(width, height) * 0.11, F.greatest(b.least_width, b.least_height) * 2.4)
    return Box(b.x1 - r, b.y1 - r, b.x2 + r, b.y2 + r).struct()


def connected_pairs(nodes: DataFrame, key: str = "node_id") -> DataFrame:
    """(image_id, a, b): unordered pairs of an image's texts that belong together. nodes: image_id,
    key, box, image_width, image_height."""
    framed = nodes.select("image_id", key, "box", "image_width", "image_height").withColumn("frame", _reach(F.col("box"), F.col("image_width"), F.col("image_height")))
    pairs = near_pairs(framed, framed, "frame", "frame", cell=REACH_CELL).where(F.col(f"l.{key}") < F.col(f"r.{key}"))
    together = G.connected(Box.of("l.box"), Box.of("r.box"), F.col("l.image_width"), F.col("l.image_height"))
    return pairs.where(together).select("image_id", F.col(f"l.{key}").alias("a"), F.col(f"r.{key}").alias("b"))


def text_groups(nodes: DataFrame, key: str = "node_id", small: int = SMALL_IMAGE) -> DataFrame:
    """nodes (one row a key) with group_id, the smallest key of their connected group. Rows without an
    image or a key are left out.

    Images of up to ``small`` texts are grouped by a task each, as arrays. In others texts whose centres
    lie in one small tile of the picture are near each other whatever their size, so tiles, and the same
    set off by half a tile, tie them without pairs; only texts apart after that are compared."""
    from glyphloom.operators import folds

    known = f"image_id is not null and {key} is not null"
    sided = " and ".join(f"box.{s} is not null" for s in ("x1", "y1", "x2", "y2"))
    texts = written(nodes.where(f"{known} and {sided}").select("image_id", key, "box", "image_width", "image_height"), "texts")
    crowded = written(texts.groupBy("image_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > small).select("image_id"), "crowded")
    n = crowded.count()
    crowded = F.broadcast(crowded) if n <= MIXED_CELLS else crowded
    found = folds.grouped_texts(texts.join(crowded, "image_id", "left_anti"), key).select("image_id", key, "group_id")
    if n:
        found = found.unionByName(_crowd_groups(texts.join(crowded, "image_id", "left_semi"), key))
    return nodes.where(known).join(found, ["image_id", key], "left").withColumn("group_id", F.coalesce("group_id", key))


def _crowd_groups(texts: DataFrame, key: str) -> DataFrame:
    b = Box.of("box")
    name = F.concat("image_id", F.lit("\u0001"), F.col(key).cast("string"))
    # 0.7 of what is near for texts of any size: a tile's diagonal is shorter than that
    side = F.greatest(F.lit(40.0), F.greatest("image_width", "image_height") * 0.11) * 0.7
    tile = lambda off: F.concat_ws("\u0002", "image_id", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("image_width", "image_height")), *(F.floor(v / side + off) for v in (b.cx, b.cy)), F.lit(off).cast("string"))
    sure = (F.abs(b.cx) < 1e9) & (F.abs(b.cy) < 1e9)
    tiled = written(texts.select("*", F.when(sure, tile(0.0)).otherwise(name).alias("_root"), _reach(F.col("box"), F.col("image_width"), F.col("image_height")).alias("frame")), "tiled")
    edges = tiled.where(sure).select(F.col("_root").alias("a"), tile(0.5).alias("b"))
    tied = written(joined_roots(tiled, "_root", edges), "tied")
    l, r = F.col("l"), F.col("r")
    of = lambda c: F.when(l[key] < r[key], l[c]).otherwise(r[c])  # noqa: E731 - the picture's size, by the smaller key
    together = G.connected(Box.of("l.box"), Box.of("r.box"), of("image_width"), of("image_height"))
    pairs = strangers(tied, "_root", "frame", cell=REACH_CELL).where(together)
    grouped = written(joined_roots(tied, "_root", pairs.select(l["_root"].alias("a"), r["_root"].alias("b"))).select("image_id", key, "_root"), "grouped")
    least = grouped.groupBy("_root").agg(F.min(key).alias("group_id"))
    return lookup_join(grouped, least, ["_root"]).drop("_root")


def group_shapes(grouped: DataFrame) -> DataFrame:
    """(image_id, group_id, size, unresolved, shape): singleton, grid, row, stack or cluster, from the
    spread of the members' centres. The columns and rows of a grid are thirds of the picture here; see
    text_places for those of the group's own box."""
    b = Box.of("box")
    third = lambda v, size: F.when(v / F.greatest(size, F.lit(1)) < 0.34, 0).when(v / F.greatest(size, F.lit(1)) <= 0.66, 1).otherwise(2)
    of = grouped.groupBy("image_id", "group_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.count(F.when(~F.coalesce("resolvable", F.lit(True)), 1)).alias("unresolved"),
        (F.max(b.cx) - F.min(b.cx)).alias("xr"),
        (F.max(b.cy) - F.min(b.cy)).alias("yr"),
        F.count_distinct(third(b.cx, F.col("image_width"))).alias("columns"),
        F.count_distinct(third(b.cy, F.col("image_height"))).alias("rows"),
    )
    grid = (F.col("size") >= 4) & (F.col("columns") >= 2) & (F.col("rows") >= 2)
    shape = F.when(F.col("size") == 1, "singleton").when(grid, "grid").when(F.col("xr") > 1.6 * F.col("yr"), "row").when(F.col("yr") > 1.6 * F.col("xr"), "stack").otherwise("cluster")
    return of.select("image_id", "group_id", "size", "unresolved", shape.alias("shape"))


def text_places(grouped: DataFrame, key: str = "node_id") -> DataFrame:
    """(image_id, key, group_id, size, unresolved, shape, x_rank, y_rank, bucket_key, bucket_occupancy,
    group_box): where every text stands in its group.

    grouped: one row a key, as of text_groups. Columns and rows are thirds of the group's box. Ranks
    count from 0, from the left and from above; equal centres share one, and of centres level in one
    direction the other decides. The bucket is singleton, the place in a row (left, middle, right) or
    stack (upper, middle, lower), else the third of the box; its occupancy counts the members whose
    third of the box has that name, so it is 0 for singletons, rows and stacks. Texts that aren't
    known to be resolvable are unresolved."""
    group, b = ["image_id", "group_id"], Box.of("box")
    members = written(grouped.where(" and ".join(f"box.{s} is not null" for s in ("x1", "y1", "x2", "y2"))).select(*group, key, "box", b.cx.alias("cx"), b.cy.alias("cy"), F.coalesce("resolvable", F.lit(False)).alias("ok")), "members")
    frames = members.groupBy(*group).agg(
        F.count(F.lit(1)).alias("size"),
        F.count(F.when(~F.col("ok"), 1)).alias("unresolved"),
        (F.max("cx") - F.min("cx")).alias("xr"),
        (F.max("cy") - F.min("cy")).alias("yr"),
        Box(F.min("box.x1"), F.min("box.y1"), F.max("box.x2"), F.max("box.y2")).struct().alias("f"),
    )
    f = Box.of("f")
    share = lambda v, low, side: (F.col(v) - low) / F.greatest(side, F.lit(1.0))
    third = G.bucket_name(share("cx", f.x1, f.width), share("cy", f.y1, f.height))
    placed = written(lookup_join(members, frames, group).withColumn("third", third), "placed")
    # at most nine rows a group
    thirds = placed.groupBy(*group, "third").agg(F.count(F.lit(1)).alias("bucket_occupancy"))
    part = lambda n: F.count_distinct(F.split_part("third", F.lit("_"), F.lit(n)))
    spread = thirds.groupBy(*group).agg(part(1).alias("rows"), part(2).alias("columns"))
    grid = (F.col("size") >= 4) & (F.col("columns") >= 2) & (F.col("rows") >= 2)
    shape = F.when(F.col("size") == 1, "singleton").when(grid, "grid").when(F.col("xr") > 1.6 * F.col("yr"), "row").when(F.col("yr") > 1.6 * F.col("xr"), "stack").otherwise("cluster")
    rank = lambda *by: F.rank().over(Window.partitionBy(*group).orderBy(*by)) - 1
    ranked = lookup_join(placed, spread, group).withColumns({"shape": shape, "x_rank": rank("cx", "cy"), "y_rank": rank("cy", "cx")})
    line = lambda at, first, last: F.when(F.col(at) == 0, first).when(F.col(at) == F.col("size") - 1, last).otherwise("middle")
    bucket = F.when(F.col("shape") == "singleton", "singleton").when(F.col("shape") == "row", line("x_rank", "left", "right")).when(F.col("shape") == "stack", line("y_rank", "upper", "lower")).otherwise(F.col("third"))
    named = ranked.withColumn("bucket_key", bucket)
    out = lookup_join(named, thirds.withColumnRenamed("third", "bucket_key"), [*group, "bucket_key"], "left")
    box = Box(*(F.bround(v, 2) for v in (f.x1, f.y1, f.x2, f.y2))).struct()
    return out.select("image_id", key, "group_id", "size", "unresolved", "shape", "x_rank", "y_rank", "bucket_key", F.coalesce("bucket_occupancy", F.lit(0)).alias("bucket_occupancy"), box.alias("group_box"))


def nearest(nodes: DataFrame, n: int = 10, key: str = "node_id", most_levels: int = 16) -> DataFrame:
    """(image_id, key, neighbor, distance_px, relation, rank): the n nearest other nodes of every node
    by centre distance rounded to a tenth, ties by key.

    Cells start at a size that holds about n nodes on average. A node looks into its own and the
    eight cells around; if n neighbours lie within a cell's side it is done, else it looks again
    with cells of three times the side, until the cells cover the image."""
    b = Box.of("box")
    base = nodes.select("image_id", F.col(key).alias("key"), "box", "image_width", "image_height", b.cx.alias("cx"), b.cy.alias("cy"))
    spread = F.sqrt((F.max("cx") - F.min("cx") + 1) * (F.max("cy") - F.min("cy") + 1) * n / F.count(F.lit(1)))
    extent = F.greatest(F.max("cx") - F.min("cx"), F.max("cy") - F.min("cy")) + 1
    sizes = base.groupBy("image_id").agg(F.greatest(spread, F.lit(1.0)).alias("side"), extent.alias("extent"))
    base = written(base.join(sizes, "image_id"), "points")
    todo, found = base.select("image_id", "key"), []
    for level in range(most_levels):
        side = F.col("side") * float(3**level)
        at = lambda c, side=side: F.floor(F.col(c) / side)
        points = base.select("image_id", F.struct("key", "box", "cx", "cy").alias("o"), at("cx").alias("gx"), at("cy").alias("gy"))
        asks = base.join(todo, ["image_id", "key"], "left_semi").withColumns({"_side": side, "gx": at("cx"), "gy": at("cy")})
        around = F.array(F.lit(-1), F.lit(0), F.lit(1))
        asks = asks.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around)).withColumns({"gx": F.col("gx") + F.col("dx"), "gy": F.col("gy") + F.col("dy")}).drop("dx", "dy")
        pairs = asks.join(points, ["image_id", "gx", "gy"]).where("key <> o.key")
        d = F.bround(G.distance(F.col("cx"), F.col("cy"), F.col("o.cx"), F.col("o.cy")), 1)
        order = Window.partitionBy("image_id", "key").orderBy("distance_px", "neighbor")
        rows = pairs.select("image_id", "key", F.col("o.key").alias("neighbor"), d.alias("distance_px"), G.direction(Box.of("box"), Box.of("o.box"), F.col("image_width"), F.col("image_height")).alias("relation"), (F.col("_side") - 0.1).alias("_sure"), (F.col("_side") >= F.col("extent")).alias("_all"))
        rows = written(rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n), "neighbors")
        full = rows.where((F.col("rank") == n) & (F.col("distance_px") <= F.col("_sure"))).select("image_id", "key")
        whole = asks.where("_side >= extent").select("image_id", "key").distinct()
        done = written(full.unionByName(whole).distinct(), "done")
        found.append(rows.join(done, ["image_id", "key"], "left_semi").select("image_id", "key", "neighbor", "distance_px", "relation", "rank"))
        todo = written(todo.join(done, ["image_id", "key"], "left_anti"), "todo")
        if todo.isEmpty():
            break
    else:
        raise ValueError(f"the {most_levels} levels of cells don't cover every image")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.withColumnRenamed("key", key)


def anchor_candidates(nodes: DataFrame, anchors: DataFrame, least: float = 0.08, columns: tuple[str, ...] = anchoring.ALL) -> DataFrame:
    """(image_id, node_id, anchor_id, label, score, source, box, text_box, area_share, relation,
    relevance), or some of these columns: anchors that stand in a relation to a text and serve it well
    enough.

    nodes: image_id, node_id, box, polygon, image_width, image_height. Relations reach 0.3 of the
    picture's width and 0.2 of its height; see ``anchoring`` for how texts and anchors meet."""
    return anchoring.candidates(nodes, anchors, least, columns)


def selection_score(generic: tuple[str, ...], generic_penalty: float = 0.075, oversize_start: float = 0.42, region_bonus: float = 0.045, support_bonus: float = 0.04) -> Column:
    """The score by which a node's anchors are ordered."""
    plain = F.col("label").isin(*generic)
    more = lambda c: F.greatest(F.coalesce(c, F.lit(1)) - 1, F.lit(0))
    value = F.col("relevance") + F.when(F.col("source") == "florence_region", region_bonus).otherwise(0.0) + F.when(plain, -generic_penalty).otherwise(0.035)
    value = value + more("support_count") * support_bonus + more("source_support_count") * (support_bonus * 0.5)
    return F.bround(value - F.greatest(F.col("area_share") - oversize_start, F.lit(0.0)) * 0.35, 6)


def best_anchors(candidates: DataFrame, n: int = 5, keys: tuple[str, ...] = ("image_id", "node_id")) -> DataFrame:
    """The first n anchors of each node by selection score, relevance, score, label; with rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("selection_score"), F.desc("relevance"), F.desc("score"), "label", "anchor_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def region_anchors(images: DataFrame) -> DataFrame:
    """(image_id, region_key, box): the nine cells of every image."""
    return images.select("image_id", F.inline(G.grid_boxes(F.col("image_width"), F.col("image_height"))))


def competitors(tuples: DataFrame) -> DataFrame:
    """tuple_id with counts of the other tuples of its image that could be meant instead.

    tuples: image_id, tuple_id, relation, label, answer, coarse, specific, bucket (normal forms, empty
    where unknown; none null), box. Equal values are counted, only boxes that overlap are paired."""
    scope = ["image_id", "relation"]
    sets = [["label"], ["coarse"], ["bucket"], ["label", "answer"], ["label", "coarse"], ["label", "specific"], ["label", "bucket"], ["coarse", "bucket"], ["label", "coarse", "specific"], ["label", "coarse", "bucket"], ["label", "specific", "bucket"], ["label", "coarse", "specific", "bucket"]]
    count = lambda *by: F.col("_n_" + "_".join(by))
    answers = tuples.groupBy(*scope, "label").agg(F.count_distinct(F.nullif("answer", F.lit(""))).alias("_answers"))
    numbered = lookup_join(with_counts(tuples, scope, {"_n_" + "_".join(s): s for s in sets}), answers, [*scope, "label"], "left")
    filled = lambda *by: " and ".join(f"{c} <> ''" for c in by) or "true"
    others = lambda *by: F.when(F.expr(filled(*(c for c in by if c != "label"))), count(*by) - 1).otherwise(F.lit(0))
    # tuples with the label and one of coarse, specific, bucket, or with coarse and bucket: by inclusion and exclusion
    lcsb = others("label", "coarse", "specific", "bucket")
    lc, ls, lb, cb = others("label", "coarse"), others("label", "specific"), others("label", "bucket"), others("coarse", "bucket")
    lcs, lcb, lsb = others("label", "coarse", "specific"), others("label", "coarse", "bucket"), others("label", "specific", "bucket")
    # label & (c|s|b) plus c & b, less what both hold: label & c & b
    confusable = lc + ls + lb - lcs - lcb - lsb + lcsb + cb - lcb
    counted = numbered.select(
        "image_id", "tuple_id",
        (count("label") - 1).alias("anchor_label_competitors"),
        others("coarse").alias("coarse_region_competitors"),
        others("bucket").alias("bucket_competitors"),
        confusable.alias("_confusable"),
        F.when(F.col("answer") != "", count("label", "answer")).otherwise(0).alias("same_anchor_same_answer_count"),
        F.col("_answers").alias("same_anchor_distinct_answer_count"),
    )
    pairs = near_pairs(tuples, tuples, on=("image_id", "relation")).where("l.tuple_id <> r.tuple_id").withColumn("v", G.iou(Box.of("l.box"), Box.of("r.box"))).where("v >= 0.35")
    same = lambda c: (F.col(f"l.{c}") == F.col(f"r.{c}")) & ((F.col(f"l.{c}") != "") if c != "label" else F.lit(True))
    already = (same("label") & (same("coarse") | same("specific") | same("bucket"))) | (same("coarse") & same("bucket"))
    by_box = pairs.groupBy("image_id", F.col("l.tuple_id").alias("tuple_id")).agg(
        F.count(F.when(F.col("v") >= 0.45, 1)).alias("anchor_overlap_competitors"),
        F.count(F.when((F.col("v") >= 0.60) & ~already, 1)).alias("_more"),
        F.count(F.when(same("label") & same("answer"), 1)).alias("_close"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = counted.join(by_box, ["image_id", "tuple_id"], "left")
    overlap = zero("anchor_overlap_competitors")
    return out.select(
        "image_id", "tuple_id", "anchor_label_competitors", overlap.alias("anchor_overlap_competitors"), "coarse_region_competitors", "bucket_competitors",
        (F.col("_confusable") + zero("_more")).alias("competing_tuples"),
        "same_anchor_same_answer_count", (F.col("same_anchor_same_answer_count") - zero("_close")).alias("same_anchor_same_answer_nonoverlap_instances"),
        "same_anchor_distinct_answer_count", ((F.col("anchor_label_competitors") >= 2) & (overlap <= 1)).alias("diffuse_same_anchor_scene"),
    )


def not_subsumed(rows: DataFrame, least: float = 0.1) -> DataFrame:
    """Rows whose set of nodes isn't part of a larger merged one of the same image and relation that
    overlaps them. rows: image_id, relation, tuple_id, box, text_node_ids, group_kind.

    Rows meet merged ones through the nodes they share, not through the image."""
    single = rows.select("image_id", "relation", F.struct("tuple_id", "box", "text_node_ids").alias("s"), F.try_element_at("text_node_ids", F.lit(1)).alias("node"))
    merged = rows.where("group_kind = 'merged'").select("image_id", "relation", F.struct("tuple_id", "box", "text_node_ids").alias("m"), F.explode("text_node_ids").alias("node"))
    part = (F.size(F.array_except("s.text_node_ids", "m.text_node_ids")) == 0) & (F.size("s.text_node_ids") < F.size("m.text_node_ids"))
    a, b = Box.of("s.box"), Box.of("m.box")
    covered = single.join(merged, ["image_id", "relation", "node"]).where(part & (F.greatest(G.overlap(a, b), G.overlap(b, a), G.iou(a, b)) >= least)).select("image_id", "s.tuple_id").distinct()
    return rows.join(covered, ["image_id", "tuple_id"], "left_anti")
