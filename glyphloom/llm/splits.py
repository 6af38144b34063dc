"""Problem 5: splits in which related records stay together.

Images are tied by a common album, file name or link. Every album and file name ties its images to
the smallest of them; the components of these ties are found by randomised contraction. Components
of equal label profile, and so of equal size, form a bundle. One flow of whole components from all
bundles to the splits, with deviation costs of rows and of every label, gives the quotas; hashes say
which components go where. Where the profiles are more than the driver may hold (MAX_CELLS), counts keep
their leading eight bits, then fewer, at last the size and the most frequent label; a bundle then carries
its components' mean.

Results for odd input: rows without an image are tied to nothing and split one by one; links with
a null end or to themselves tie nothing, links to images without rows tie others through them; a
null link kind is not a rejection; null paths, sources and keep_whole tie nothing; an empty table
gives no rows; a tuple delivered several times counts once; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import alike_key
from glyphloom.llm.draw import MAX_CELLS, draw
from glyphloom.llm.flow import DealFlow
from glyphloom.operators.graph import FINISH_EDGES, components
from glyphloom.operators.skew import HEAVY_ROWS, HEAVY_SHARE, lookup_join
from glyphloom.session import written

#: Classes of the label in a profile: its most frequent values one by one, all others, and null.
LABELS = 256
#: Counts of bundles by label that the driver holds.
PROFILE_CELLS = 200_000


def file_key(path: Column) -> Column:
    """The last component of a path in lower case; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(path, r"([^/]*)$", 1)), F.lit(""))


def _stars(members: DataFrame) -> DataFrame:
    """(a, b): of distinct (hub, a) rows, each member with its hub's smallest."""
    hubs = members.groupBy("hub").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = written(hubs, "hubs")
    bound = hubs.agg(F.greatest(F.sum("n") * F.lit(HEAVY_SHARE), F.lit(float(HEAVY_ROWS))).alias("least"))
    heavy = hubs.join(F.broadcast(bound), F.col("n") >= F.col("least")).select("hub")
    return lookup_join(members, hubs.select("hub", "b"), ["hub"], heavy=heavy).where("a <> b").select("a", "b")


def ties(tuples: DataFrame, registry: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b): edges whose components are the images that must share a split."""
    seen = tuples.where("image_id is not null").select("image_id", alike_key(F.col("source_dataset")).alias("source"), file_key(F.col("image_path")).alias("file"))
    seen = written(seen.distinct(), "seen")
    whole = registry.where("keep_whole").select(alike_key(F.col("source_dataset")).alias("source")).where("source is not null").distinct()
    album = lookup_join(seen.select(F.col("image_id").alias("a"), "source").where("source is not null"), whole, ["source"])
    hubs = album.select(F.concat(F.lit("source:"), "source").alias("hub"), "a")
    hubs = hubs.unionByName(seen.where("file is not null").select(F.concat(F.lit("file:"), "file").alias("hub"), F.col("image_id").alias("a")))
    linked = links.where("image_id_a <> image_id_b and (link_kind is null or link_kind <> 'rejected')")
    return _stars(written(hubs.distinct(), "members")).unionByName(linked.select(F.col("image_id_a").alias("a"), F.col("image_id_b").alias("b")))


def groups_of(tuples: DataFrame, registry: DataFrame, links: DataFrame, finish_edges: int = FINISH_EDGES) -> DataFrame:
    """(image_id, group_id): the images that have rows; group_id is the smallest of those that
    belong together."""
    images = tuples.where("image_id is not null").select(F.col("image_id").alias("node")).distinct()
    roots = components(ties(tuples, registry, links), finish_edges)
    here = written(images.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "here")
    least = here.groupBy("root").agg(F.min("node").alias("group_id"))
    return lookup_join(here, least, ["root"]).select(F.col("node").alias("image_id"), "group_id")


def _coarse(n: Column, bits: int | None) -> Column:
    """Its leading ``bits`` bits, or itself."""
    if bits is None:
        return n
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - (bits - 1), F.lit(0))).cast("long")
    return (n - F.pmod(n, step)).cast("long")


def bundle_quotas(bundles: dict[str, tuple[int, dict[int, int]]], shares: dict[str, float]) -> dict[str, dict[tuple, int]]:
    """split -> bundle -> components. bundles: components and, over all of them, rows by label."""
    names = sorted(bundles)
    codes = sorted({c for _, profile in bundles.values() for c in profile})
    at = {c: k for k, c in enumerate(codes, 1)}
    amounts, contents = np.array([bundles[b][0] for b in names], dtype=np.int64), np.zeros((len(names), len(codes) + 1))
    for i, b in enumerate(names):
        n, profile = bundles[b]
        for c, rows in profile.items():
            contents[i, at[c]] = rows / n
        contents[i, 0] = sum(profile.values()) / n
    flow = DealFlow(amounts, contents, np.array(list(shares.values()))).solve()
    return {s: {(b,): int(n) for b, n in zip(names, flow[:, k])} for k, s in enumerate(shares)}


@dataclass(frozen=True)
class Splits:
    rows: DataFrame  # (ann_id, image_id, label, group_id), a written table
    groups: DataFrame  # (image_id, group_id)
    dealt: DataFrame  # (group_id, split), a written table

    def tuples(self) -> DataFrame:
        """(ann_id, image_id, label, group_id, split) of every tuple."""
        return lookup_join(self.rows, self.dealt, ["group_id"]).select("ann_id", "image_id", "label", "group_id", "split")

    def images(self) -> DataFrame:
        """(image_id, group_id, split) of every image."""
        return lookup_join(self.groups, self.dealt, ["group_id"]).select("image_id", "group_id", "split")

    def balance(self) -> DataFrame:
        """(split, label, rows): how many rows with each label every split has."""
        return self.tuples().groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


def split(tuples: DataFrame, groups: DataFrame, label: str, shares: dict[str, float], seed: int = 0) -> Splits:
    """Deals the groups to splits; shares are of tuples and sum to 1.

    label: the column whose values' counts make a group's profile. The LABELS - 2 most frequent values
    are counted one by one, the others together, and nulls."""
    groups = written(groups, "groups")
    newest = F.max(F.struct("image_id", F.col(label).alias("label")))
    rows = tuples.where("ann_id is not null").groupBy("ann_id").agg(newest.alias("m")).select("ann_id", "m.image_id", "m.label")
    rows = written(rows, "newest")
    rows = lookup_join(rows, groups, ["image_id"], "left").withColumn("group_id", F.coalesce("group_id", F.concat(F.lit("row:"), "ann_id")))
    rows = written(rows, "rows")
    top = [r["label"] for r in rows.where("label is not null").groupBy("label").count().orderBy(F.desc("count"), "label").limit(LABELS - 2).collect()]
    known = F.array_position(F.array(*map(F.lit, top)), F.col("label")) if top else F.lit(0)  # 0: none of them
    code = F.when(F.col("label").isNull(), -1).otherwise(known).cast("int")
    counted = rows.groupBy("group_id", code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    # a group has at most LABELS codes
    grouped = counted.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("code", "n"))).alias("profile"))
    grouped = written(grouped, "grouped")
    for bits in (None, 8, 6, 5, 4, 3, 2, 1, 0):
        if bits:
            parts = F.transform("profile", lambda p, bits=bits: F.concat_ws(":", p["code"], _coarse(p["n"], bits)))
        elif bits is None:
            parts = F.transform("profile", lambda p: F.concat_ws(":", p["code"], p["n"]))
        else:  # at last the size and which label is the most frequent: few hundred for each label
            size = F.aggregate("profile", F.lit(0).cast("long"), lambda a, p: a + p["n"])
            most = F.array_max(F.transform("profile", lambda p: F.struct(p["n"].alias("n"), (-p["code"]).alias("c"))))
            parts = F.array(F.concat_ws(":", -most["c"], _coarse(size, 4)))
        bundled = grouped.select("group_id", F.array_join(parts, ",").alias("bundle"), "profile")
        sums = bundled.select("bundle", F.explode("profile").alias("p")).groupBy("bundle", F.col("p.code").alias("code")).agg(F.sum("p.n").alias("rows"))
        cells = sums.limit(PROFILE_CELLS + 1).collect()
        if len(cells) <= PROFILE_CELLS and len({r["bundle"] for r in cells}) <= MAX_CELLS:
            break
    else:
        raise ValueError(f"more than {MAX_CELLS} bundles or {PROFILE_CELLS} counts of them")
    amounts = {r["bundle"]: r["n"] for r in bundled.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).collect()}  # no more than cells
    profiles: dict[str, dict[int, int]] = {}
    for r in cells:
        profiles.setdefault(r["bundle"], {})[r["code"]] = r["rows"]
    quotas = bundle_quotas({b: (amounts[b], p) for b, p in profiles.items()}, shares)
    left, parts = bundled.select("group_id", "bundle"), []
    *some, last = sorted(shares, key=lambda s: shares[s])
    for i, s in enumerate(some):
        mine = written(draw(left, ["bundle"], "group_id", quotas[s], seed + i).select("group_id"), "drawn")
        parts.append(mine.withColumn("split", F.lit(s)))
        left = left.join(mine, "group_id", "left_anti")
    at = left.select("group_id", F.lit(last).alias("split"))
    for p in parts:
        at = at.unionByName(p)
    return Splits(rows, groups, written(at, "dealt"))


def tied_pairs(images: DataFrame) -> DataFrame:
    """(image_id_a, image_id_b): each group's smallest image with every other one, which share a split."""
    return images.where("image_id <> group_id").select(F.col("group_id").alias("image_id_a"), F.col("image_id").alias("image_id_b"))
