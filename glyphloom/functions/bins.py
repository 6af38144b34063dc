"""Bins, tags and small scores of text rows, as column expressions. Bin names are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphloom.functions.normalize import strip


def binned(c: Column, first: str, *steps: tuple[float, str], above: bool = False) -> Column:
    """``first`` up to the first step's bound, then each step's name beyond its bound.

    Bounds belong to the bin above them, or with ``above`` to the bin below."""
    out = F.lit(first)
    for bound, name in steps:
        out = F.when(c > bound if above else c >= bound, name).otherwise(out)
    return F.when(c.isNotNull(), out)


def density(count: Column) -> Column:
    return binned(count, "low", (5, "medium"), (14, "high"), above=True)


def area(share: Column) -> Column:
    return binned(share, "small", (0.005, "medium"), (0.02, "large"))


def confidence(c: Column) -> Column:
    return F.when(c > 0.95, "high_>0.95").otherwise(binned(c, "low_0.80-0.85", (0.85, "medium_0.85-0.95")))


def text_length(text: Column) -> Column:
    return binned(F.length(strip(text)), "single_char", (1, "short_2-4"), (4, "medium_5-10"), (10, "long_11+"), above=True)


def text_density(count: Column) -> Column:
    return binned(count, "sparse_1-2", (2, "moderate_3-5"), (5, "dense_6+"), above=True)


def text_size(share: Column) -> Column:
    return F.when(share > 0.10, "large_>10pct").otherwise(binned(share, "tiny_<1pct", (0.01, "small_1-3pct"), (0.03, "medium_3-10pct")))


def anchor_score(score: Column) -> Column:
    return F.when(score > 0.75, "high_>0.75").otherwise(binned(score, "low_<0.50", (0.50, "medium_0.50-0.75")))


def ambiguity(score: Column) -> Column:
    return binned(score, "low", (1, "medium"), (4, "high"), above=True)


def size_score(share: Column, text: Column) -> Column:
    """Size and length of a text in one number."""
    return share * 100 + F.least(F.length(strip(text)), F.lit(16)) / 16.0


def _points(*terms: tuple[Column, int]) -> Column:
    total = F.lit(0)
    for holds, n in terms:
        total = total + F.when(holds, n).otherwise(0)
    return total


def difficulty(size: Column, crowd: Column, unique: Column, length: Column, conf: Column, kind: Column, ambiguous: Column) -> Column:
    """easy, medium or hard, by points for what makes a question hard; arguments are bin names."""
    points = _points(
        (size == "tiny_<1pct", 3),
        (size == "small_1-3pct", 2),
        (size == "medium_3-10pct", 1),
        (crowd == "dense_6+", 2),
        (crowd == "moderate_3-5", 1),
        (~F.coalesce(unique, F.lit(False)), 1),
        (length == "long_11+", 1),
        (conf == "low_0.80-0.85", 1),
        (kind.isin("REVERSE_GROUND", "TEXT_PROPERTY", "ANCHOR_PROPERTY"), 1),
        (ambiguous == "high", 2),
        (ambiguous == "medium", 1),
    )
    return binned(points, "easy", (1, "medium"), (3, "hard"), above=True)


def ambiguity_score(competing: Column, coarse: Column, bucket: Column, overlapping: Column, conflicts: Column, cluster: Column, shape: Column, occupancy: Column, unresolved: Column, nearby: Column) -> Column:
    """Points for what else in the picture an anchor's description could mean; counts may be null."""
    n = lambda c: F.coalesce(c, F.lit(0))
    return _points(
        (n(competing) > 0, 3),
        (n(coarse) > 0, 2),
        (n(bucket) > 0, 2),
        (n(overlapping) > 0, 2),
        (n(conflicts) > 0, 1),
        (n(cluster) >= 4, 2),
        (n(cluster) == 3, 1),
        (F.coalesce(shape, F.lit("")) == "grid", 2),
        (n(occupancy) >= 2, 2),
        (n(unresolved) >= 2, 1),
        (n(nearby) >= 4, 1),
    )


def candidate_quality(ocr: Column, anchor: Column, px_width: Column, unique: Column, sign: Column, crowd: Column, ambiguous: Column) -> Column:
    """Weighted sum of what makes a candidate worth asking about."""
    small = F.least(px_width / 96.0, F.lit(1.0))
    return ocr * 0.38 + anchor * 0.12 + small * 0.23 + F.when(unique, 0.17).otherwise(0.17 * 0.45) + F.when(sign, 0.18).otherwise(0.0) - F.when(crowd >= 12, 0.12).otherwise(0.0) - ambiguous * 0.05
