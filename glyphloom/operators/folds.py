"""Folds within images whose result depends on the order of the rows.

A fold sees the rows of one block in a stated order. A block is an image; of an image with more than
BLOCK_ROWS rows it is the rows of one label or relation, if a cluster has but one, and if these are
more than BLOCK_ROWS too, a group of boxes that overlap, directly or through others, since boxes that
don't can't fall into one cluster. Spark shuffles by block and sorts; the fold runs over the sorted
stream, a block at a time, so a task holds one block and one batch of rows.

Results for odd input: nulls sort first in rising and last in falling order; rows without all four
sides of the box are left out; equal rows are told apart by the key, which should be unique.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphloom.operators.boxes import touching
from glyphloom.session import ship, written

BLOCK_ROWS = 10_000


def blocks(df: DataFrame, key: str, box: str = "box", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """df with block_id: the image, or in large images the group of overlapping boxes.

    A column _part, if there is one, tells apart rows that can't fall into one cluster: a large image
    is cut by it first, and only what is still large by overlaps. At most rows / block_rows images are
    large; their list is met by broadcast."""
    df = written(df.where(" and ".join(f"{box}.{s} is not null" for s in ("x1", "y1", "x2", "y2"))), "boxes")
    many = lambda d, by: d.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows).select(by)
    large = written(many(df, "image_id"), "large")
    if large.isEmpty():
        return df.withColumn("block_id", F.col("image_id")).drop("_part")
    large = F.broadcast(large)
    part = ["_part"] if "_part" in df.columns else []
    heavy = df.join(large, "image_id", "left_semi").withColumn("block_id", F.concat_ws("\u0001", "image_id", *part))
    out = df.join(large, "image_id", "left_anti").withColumn("block_id", F.col("image_id"))
    crowded = written(many(heavy, "block_id"), "crowded")
    out = out.unionByName(heavy.join(F.broadcast(crowded), "block_id", "left_anti"))
    if not crowded.isEmpty():
        named = heavy.join(F.broadcast(crowded), "block_id", "left_semi").withColumn("_name", F.concat_ws("\u0001", "block_id", F.col(key).cast("string")))
        groups = touching(written(named, "crowd"), "_name", "block_id", box)
        out = out.unionByName(groups.withColumn("block_id", F.col("_root")).drop("_name", "_root"))
    return out.drop("_part")


class Block:
    """The rows of a block as lists, in order."""

    def __init__(self, columns: dict[str, list], start: int, end: int):
        self.columns, self.start, self.end = columns, start, end

    def __len__(self) -> int:
        return self.end - self.start

    def __getitem__(self, name: str) -> list:
        return self.columns[name][self.start : self.end]

    def text(self, name: str) -> list[str]:
        return ["" if x is None else x for x in self[name]]

    def number(self, name: str, default: float = 0.0) -> np.ndarray:
        return np.nan_to_num(np.array([default if x is None else x for x in self[name]], dtype=float), nan=default)

    def boxes(self, name: str = "box") -> np.ndarray:
        return np.array([(b["x1"], b["y1"], b["x2"], b["y2"]) for b in self[name]], dtype=float).reshape(-1, 4)


#: A step gives the kept rows, in their new order, and new or changed columns for them.
Step = Callable[[Block], tuple[list[int], dict[str, list]]]


def fold(df: DataFrame, order: list[Column], step: Step, more: str = "") -> DataFrame:
    """df with the rows that step keeps of every block and the columns it adds (a DDL string)."""
    ship(df.sparkSession)
    columns = df.columns
    schema = T.StructType([*df.schema.fields, *(T.StructType.fromDDL(more).fields if more else [])])

    def solve(f: pd.DataFrame) -> pd.DataFrame:
        ids = f["block_id"].to_numpy()
        ends = np.append(np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids)).tolist()
        lists = {c: f[c].tolist() for c in columns}
        rows: list[int] = []
        new: dict[str, list] = {}
        start = 0
        for end in ends:
            kept, changed = step(Block(lists, start, end))
            rows.extend(start + i for i in kept)
            for name, values in changed.items():
                new.setdefault(name, []).extend(values)
            start = end
        return f.iloc[rows].assign(**{n: pd.Series(v, dtype=object).to_numpy() for n, v in new.items()})[schema.names]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left: list[pd.DataFrame] = []  # of the block that isn't complete
        for f in frames:
            if not len(f):
                continue
            ids = f["block_id"].to_numpy()
            if left and left[0]["block_id"].iloc[0] != ids[0]:
                yield solve(pd.concat(left, ignore_index=True))
                left = []
            other = np.flatnonzero(ids != ids[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield solve(pd.concat([*left, f.iloc[:cut]], ignore_index=True))
                left = []
            left.append(f.iloc[cut:])
        if left:
            yield solve(pd.concat(left, ignore_index=True))

    return df.repartition("block_id").sortWithinPartitions("block_id", *order).mapInPandas(run, schema)


class Overlaps:
    """Overlaps of one box with the boxes kept so far, all at once.

    least, if at least a half: boxes share that much of the larger's area, or more, wherever it matters.
    Then each side is shared in that part too, so kept boxes are looked up by the sizes of their sides
    (powers of two) and the place of their corner (cells of half that size)."""

    #: Up to so many boxes all are measured.
    FEW = 128

    def __init__(self, size: int, least: float = 0.0):
        self.kept = np.zeros((size, 4))
        self.n = 0
        self.least = least if least >= 0.5 else 0.0
        self.cells: dict[tuple[int, int, int, int], list[int]] = {}
        self.places: list[tuple[int, int, int, int] | None] = []
        #: the kept boxes that were measured last
        self.at = np.zeros(0, dtype=int)

    def _place(self, box: np.ndarray) -> tuple[int, int, int, int] | None:
        x1, y1, x2, y2 = box.tolist()
        if not (0 < x2 - x1 < math.inf and 0 < y2 - y1 < math.inf):
            return None  # shares no part of its area
        kw, kh = math.frexp(x2 - x1)[1], math.frexp(y2 - y1)[1]
        return kw, kh, math.floor(math.ldexp(x1, 1 - kw)), math.floor(math.ldexp(y1, 1 - kh))

    def add(self, box: np.ndarray) -> None:
        self.kept[self.n] = box
        if self.least:
            self.places.append(self._place(box))
            if self.places[-1]:
                self.cells.setdefault(self.places[-1], []).append(self.n)
        self.n += 1

    def replace(self, i: int, box: np.ndarray) -> None:
        self.kept[i] = box
        if self.least and (new := self._place(box)) != self.places[i]:
            if self.places[i]:
                self.cells[self.places[i]].remove(i)
            if new:
                self.cells.setdefault(new, []).append(i)
            self.places[i] = new

    def _near(self, box: np.ndarray) -> np.ndarray:
        if not self.least or self.n <= self.FEW:
            return np.arange(self.n)
        x1, y1, x2, y2 = box.tolist()
        if not (0 < x2 - x1 < math.inf and 0 < y2 - y1 < math.inf):
            return np.zeros(0, dtype=int)
        t = self.least * (1 - 1e-9)

        def reached(low: float, size: float) -> list[tuple[int, int, int]]:
            """Sizes and cells of kept sides that share t of the longer with this one."""
            most, out = size / t, []
            for k in range(math.frexp(size * t)[1], math.frexp(most)[1] + 1):
                far = (1 - t) * min(math.ldexp(1.0, max(k, math.frexp(size)[1])), most) + 1e-9 * (abs(low) + size)
                out.append((k, math.floor(math.ldexp(low - far, 1 - k)), math.floor(math.ldexp(low + far, 1 - k)) + 1))
            return out

        found: list[int] = []
        ys = reached(y1, y2 - y1)
        for kw, xa, xb in reached(x1, x2 - x1):
            for kh, ya, yb in ys:
                for gx in range(xa, xb):
                    for gy in range(ya, yb):
                        if rows := self.cells.get((kw, kh, gx, gy)):
                            found.extend(rows)
        found.sort()
        return np.array(found, dtype=int)

    def measure(self, box: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(share of box in kept ones, of them in box, intersection over union), of those in ``at``."""
        self.at = self._near(box)
        k = self.kept[self.at] if len(self.at) < self.n else self.kept[: self.n]
        side = lambda lo, hi: np.clip(np.minimum(box[hi], k[:, hi]) - np.maximum(box[lo], k[:, lo]), 0, None)
        s = side(0, 2) * side(1, 3)
        own, theirs = max((box[2] - box[0]) * (box[3] - box[1]), 1e-6), np.maximum((k[:, 2] - k[:, 0]) * (k[:, 3] - k[:, 1]), 1e-6)
        return s / own, s / theirs, s / np.maximum(own + theirs - s, 1e-6)

    def alike(self, box: np.ndarray) -> np.ndarray:
        a, b, u = self.measure(box)
        return np.maximum(np.minimum(a, b), u)


Fits = Callable[[Overlaps, np.ndarray], np.ndarray]


def exemplars(b: Block, fits: Fits, same: list[str], least: float = 0.0) -> list[list[int]]:
    """Clusters of rows: each joins the first whose first member fits it and agrees in ``same``. least:
    of the larger's area what fitting boxes share at least."""
    keys, clusters, o = list(zip(*map(b.text, same))) if same else [()] * len(b), [], Overlaps(len(b), least)
    for i, box in enumerate(b.boxes()):
        near = np.flatnonzero(fits(o, box)) if o.n else []
        fit = o.at[near].tolist() if len(near) else []
        at = next((c for c in fit if keys[clusters[c][0]] == keys[i]), None)
        if at is None:
            clusters.append([i])
            o.add(box)
        else:
            clusters[at].append(i)
    return clusters


def like(least: float, iou: float) -> Fits:
    """Mutual overlap of at least ``least``, or intersection over union of at least ``iou``."""

    def fits(o: Overlaps, box: np.ndarray) -> np.ndarray:
        a, b, u = o.measure(box)
        return (np.minimum(a, b) >= least) | (u >= iou)

    return fits


def distinct_by(b: Block, duplicate: Callable[[Overlaps, np.ndarray, list[int], int], bool], least: float = 0.0) -> list[int]:
    """Rows that are no duplicate of one kept before; least as in exemplars."""
    kept, o = [], Overlaps(len(b), least)
    for i, box in enumerate(b.boxes()):
        if not (o.n and duplicate(o, box, kept, i)):
            o.add(box)
            kept.append(i)
    return kept


def _known(c: str) -> Column:
    """As the folds take texts: what is null is empty."""
    return F.coalesce(c, F.lit(""))


def _area(box: str = "box", least: float = 0.0) -> Column:
    side = lambda n: F.greatest(F.col(f"{box}.{n}2") - F.col(f"{box}.{n}1"), F.lit(least))
    return side("x") * side("y")


def merge_detections(df: DataFrame, least: float = 0.62, most: int = 128) -> DataFrame:
    """Detections of several detectors, merged: each, most confident first, goes into the kept box
    most like it, which grows to hold both; sources (an array column) are united. At most ``most``
    of an image, those kept first; number counts them. df: image_id, key, box, confidence, sources."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        o, kept, confidence, sources = Overlaps(len(b), least), [], [], []
        conf, names = b.number("confidence"), b["sources"]
        for i, box in enumerate(b.boxes()):
            score = o.alike(box) if o.n else np.zeros(0)
            at = int(o.at[score.argmax()]) if len(score) and score.max() >= least else -1
            if at < 0:
                o.add(box)
                kept.append(i)
                confidence.append(float(conf[i]))
                sources.append(list(dict.fromkeys(names[i])))
                continue
            k = o.kept[at]
            o.replace(at, np.round([*np.minimum(k[:2], box[:2]), *np.maximum(k[2:], box[2:])], 2))
            confidence[at] = max(confidence[at], float(conf[i]))
            sources[at] = list(dict.fromkeys([*sources[at], *names[i]]))
        grown = [dict(zip(("x1", "y1", "x2", "y2"), k)) for k in o.kept[: o.n].tolist()]
        return kept, {"box": grown, "confidence": confidence, "sources": sources, "_n": list(range(1, len(kept) + 1))}

    from pyspark.sql import Window

    named = blocks(df.withColumn("_first", F.struct("confidence", _area().alias("area"))), "key")
    out = fold(named, [F.desc("confidence"), F.desc(_area()), F.asc("key")], step, "_n int")
    # blocks of one image are numbered through in the order in which their boxes were kept
    w = Window.partitionBy("image_id").orderBy(F.desc("_first.confidence"), F.desc("_first.area"), "key", "block_id", "_n")
    return out.withColumn("number", F.row_number().over(w)).where(F.col("number") <= most).drop("_n", "_first", "block_id")


def dedupe_anchors(df: DataFrame, least: float = 0.85) -> DataFrame:
    """Anchors without those that a better one of the same label covers and is covered by. df:
    image_id, key, label, box, score."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        labels = b.text("label")

        def duplicate(o: Overlaps, box: np.ndarray, kept: list[int], i: int) -> bool:
            x, y, _ = o.measure(box)
            return any(labels[kept[j]] == labels[i] for j in o.at[np.flatnonzero((x >= least) & (y >= least))])

        return distinct_by(b, duplicate, least), {}

    return fold(blocks(df.withColumn("_part", _known("label")), "key"), [F.desc("score"), F.asc("label"), F.asc("key")], step).drop("block_id")


def dedupe_nodes(df: DataFrame, least: float = 0.74, iou: float = 0.60) -> DataFrame:
    """Text nodes without those whose box is like a better one's and whose text is part of its text,
    or it of theirs. df: image_id, key, box, text, text_normalized, confidence."""
    fits = like(least, iou)

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        texts = b.text("text_normalized")

        def duplicate(o: Overlaps, box: np.ndarray, kept: list[int], i: int) -> bool:
            fit = np.flatnonzero(fits(o, box))
            near = (texts[kept[j]] for j in o.at[fit])
            return bool(texts[i]) and any(t and (t in texts[i] or texts[i] in t) for t in near)

        return distinct_by(b, duplicate, min(least, iou)), {}

    order = [F.desc("confidence"), F.desc(F.length(F.coalesce("text", F.lit("")))), F.desc(_area(least=1.0)), F.asc("key")]
    return fold(blocks(df, "key"), order, step).drop("block_id")


def _numbered(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """df, folded in blocks, with its clusters numbered through over each image as if that were one
    block: by the order of their first members (_first), in a block by _n."""
    from pyspark.sql import Window

    w = Window.partitionBy("image_id").orderBy(*order, "block_id", "_n")
    return df.withColumn(name, F.dense_rank().over(w)).drop("_first", "_n", "block_id")


def relabel_groups(df: DataFrame, conflict: float = 0.78) -> DataFrame:
    """df with group_no: tuples of one relation whose anchors are like the group's first. df: image_id,
    key, relation, box, anchor_score."""
    iou = max(0.55, conflict - 0.08)
    fits = like(conflict, iou)

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        clusters, first = exemplars(b, fits, ["relation"], min(conflict, iou)), b["_first"]
        return list(chain.from_iterable(clusters)), {"_first": [first[c[0]] for c in clusters for _ in c], "_n": [n for n, c in enumerate(clusters, 1) for _ in c]}

    order = lambda at="": [F.asc(f"{at}relation"), F.desc(f"{at}anchor_score"), F.asc(f"{at}key")]
    named = blocks(df.withColumn("_part", _known("relation")), "key").withColumn("_first", F.struct("relation", "anchor_score", "key"))
    return _numbered(fold(named, order(), step, "_n int"), "group_no", order("_first."))


def consolidate(df: DataFrame, plain: tuple[str, ...], conflict: float = 0.78) -> DataFrame:
    """Candidates for the same thing as one row each: the label with the most weight, its best row,
    the other labels and how many there were. df: image_id, key, relation, box, label (clean),
    selection_score, score, support_count, source."""
    iou = max(0.55, conflict - 0.10)
    fits = like(conflict, iou)

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        labels, chosen, score, support, source = b.text("label"), b.number("selection_score"), b.number("score"), b.number("support_count", 1.0), b.text("source")
        weight = [chosen[i] + 0.10 * max(support[i], 1.0) + 0.08 * (x not in plain) + 0.04 * (len(x.split()) >= 2) + 0.03 * (source[i] == "florence_region") for i, x in enumerate(labels)]
        kept, new = [], {n: [] for n in ("alternate_labels", "label_conflict_count", "cluster_size", "support_count")}
        for rows in exemplars(b, fits, ["relation"], min(conflict, iou)):
            vote: dict[str, float] = {}
            for i in rows:
                vote[labels[i]] = vote.get(labels[i], 0.0) + weight[i]
            label = max(vote, key=lambda x: (vote[x], x not in plain, len(x.split()), x))
            kept.append(max((i for i in rows if labels[i] == label), key=lambda i: (chosen[i], score[i], -i)))
            for n, v in zip(new, (sorted(vote), len(vote) - 1, len(rows), max(int(support[kept[-1]]), len(rows)))):
                new[n].append(v)
        return kept, new

    order = [F.desc("selection_score"), F.desc("score"), F.asc("label"), F.asc("key")]
    return fold(blocks(df, "key"), order, step, "alternate_labels array<string>, label_conflict_count int, cluster_size int").drop("block_id")


def anchor_clusters(df: DataFrame, least: float = 0.1) -> DataFrame:
    """One row, that of the best anchor, for texts that stand on like anchors: with cluster_no (its
    number in the image), the box around them, their keys and distinct labels. df: image_id, key, box
    (the anchor's), label, selection_score, score."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        boxes, labels, keys, chosen, score, first = b.boxes(), b.text("label"), b["key"], b.number("selection_score"), b.number("score"), b["_first"]
        kept, new = [], {n: [] for n in ("box", "_first", "_n", "member_keys", "labels")}
        for n, rows in enumerate(exemplars(b, lambda o, box: o.alike(box) >= least, []), 1):
            kept.append(max(rows, key=lambda i: (chosen[i], score[i], -i)))
            lo, hi = boxes[rows].min(axis=0).tolist(), boxes[rows].max(axis=0).tolist()
            new["box"].append({"x1": lo[0], "y1": lo[1], "x2": hi[2], "y2": hi[3]})
            new["_first"].append(first[rows[0]])
            new["_n"].append(n)
            new["member_keys"].append([str(keys[i]) for i in rows])
            new["labels"].append(list(dict.fromkeys(labels[i] for i in rows if labels[i].strip())))
        return kept, new

    order = lambda at="": [F.desc(f"{at}score"), F.asc(f"{at}label"), F.asc(f"{at}key")]
    named = blocks(df, "key").withColumn("_first", F.struct("score", "label", "key"))
    return _numbered(fold(named, order(), step, "_n int, member_keys array<string>, labels array<string>"), "cluster_no", order("_first."))


def merge_passes(df: DataFrame, iou: float = 0.55, least_passes: int = 1) -> DataFrame:
    """Inventories of several passes as one: boxes of one label that are like the cluster's first;
    clusters seen in too few passes are dropped, more passes raise the score. df: image_id, key,
    pass_index, label, raw_label, box, score."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        passes, label, raw, score = b["pass_index"], b.text("label"), b.text("raw_label"), b.number("score")
        kept, new = [], {n: [] for n in ("score", "pass_support_count", "alternate_labels")}
        for rows in exemplars(b, lambda o, box: o.measure(box)[2] >= iou, ["label"], iou):
            n = len({passes[i] for i in rows})
            if n >= max(1, least_passes):
                kept.append(max(rows, key=lambda i: (score[i], raw[i], -i)))
                new["score"].append(round(float(score[kept[-1]]) + 0.03 * (n - 1), 4))
                new["pass_support_count"].append(n)
                new["alternate_labels"].append(sorted({(raw[i] or label[i]).strip() for i in rows} - {""}))
        return kept, new

    order = [F.desc("score"), F.asc("label"), F.asc("key")]
    return fold(blocks(df.where("coalesce(label, '') <> ''").withColumn("_part", _known("label")), "key"), order, step, "pass_support_count int, alternate_labels array<string>").drop("block_id")


def with_support(df: DataFrame) -> DataFrame:
    """Candidates with support_count, source_support_count and support_labels: of those of the same
    node and relation whose boxes speak for the same thing, itself included: one has 0.35 of the
    other in it, or their centres are within 0.22 of the longer diagonal. df: image_id, node_id,
    anchor_id, relation, box, label, source. A block is a node and relation: the anchors in reach
    of one text, compared as arrays."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        k, labels, sources = b.boxes(), b.text("label"), [x or "unknown" for x in b["source"]]
        area = np.maximum((k[:, 2] - k[:, 0]) * (k[:, 3] - k[:, 1]), 1e-6)
        cx, cy, diagonal = (k[:, 0] + k[:, 2]) / 2, (k[:, 1] + k[:, 3]) / 2, np.hypot(k[:, 2] - k[:, 0], k[:, 3] - k[:, 1])
        new = {n: [] for n in ("support_count", "source_support_count", "support_labels")}
        for i in range(len(b)):
            side = lambda lo, hi, i=i: np.clip(np.minimum(k[i, hi], k[:, hi]) - np.maximum(k[i, lo], k[:, lo]), 0, None)
            shared = side(0, 2) * side(1, 3)
            near = np.sqrt((cx - cx[i]) ** 2 + (cy - cy[i]) ** 2) <= 0.22 * np.maximum(np.maximum(diagonal, diagonal[i]), 1.0)
            at = np.flatnonzero((shared / np.minimum(area, area[i]) >= 0.35) | near).tolist()
            new["support_count"].append(len(at))
            new["source_support_count"].append(len({sources[j] for j in at}))
            new["support_labels"].append(sorted({labels[j] for j in at} - {""}))
        return list(range(len(b))), new

    d = df.withColumn("block_id", F.concat_ws("\u0001", "image_id", "node_id", "relation"))
    return fold(d, [F.asc("anchor_id")], step, "support_count long, source_support_count long, support_labels array<string>").drop("block_id")


def grouped_texts(df: DataFrame, key: str) -> DataFrame:
    """df (image_id, key, box, image_width, image_height) with group_id, the first key of those that are
    connected (geometry.connected), directly or through others. An image is a block: for small ones."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        n, keys = len(b), b[key]
        if n == 1:
            return [0], {"group_id": keys}
        k = b.boxes()
        x1, y1, x2, y2 = k.T
        w, h = x2 - x1, y2 - y1
        sides = np.array([[np.nan if v is None else v for v in b[c]] for c in ("image_width", "image_height")], dtype=float)
        high, long = np.maximum(h, 1.0), np.maximum(np.maximum(w, 1.0), np.maximum(h, 1.0))
        pair = lambda f, v: f(v[:, None], v)
        sx, sy = pair(np.minimum, x2) - pair(np.maximum, x1), pair(np.minimum, y2) - pair(np.maximum, y1)
        gap_x, gap_y = np.maximum(-sx, 0.0), np.maximum(-sy, 0.0)
        sx, sy = np.maximum(sx, 0.0), np.maximum(sy, 0.0)
        touch = sx * sy / np.maximum(pair(np.minimum, np.maximum(w * h, 1e-6)), 1e-6) >= 0.05
        beside = (sy / np.maximum(pair(np.minimum, h), 1e-6) >= 0.3) & (gap_x <= 2.2 * pair(np.maximum, high))
        stacked = (sx / np.maximum(pair(np.minimum, w), 1e-6) >= 0.3) & (gap_y <= 2.2 * pair(np.maximum, high))
        dx, dy = pair(np.subtract, (x1 + x2) / 2), pair(np.subtract, (y1 + y2) / 2)
        reach = np.fmax(40.0, np.fmax(*sides) * 0.11)[:, None]  # of the smaller key's picture
        near = np.sqrt(dx * dx + dy * dy) <= np.maximum(reach, pair(np.maximum, long) * 2.4)
        tied = np.triu(touch | beside | stacked | near, 1)
        tied |= tied.T | np.eye(n, dtype=bool)
        root = np.arange(n)
        while True:
            least = np.where(tied, root, n).min(axis=1)
            if (least == root).all():
                return list(range(n)), {"group_id": [keys[i] for i in root.tolist()]}
            root = least

    kind = df.schema[key].dataType.simpleString()
    return fold(df.withColumn("block_id", F.col("image_id")), [F.asc(key)], step, f"group_id {kind}").drop("block_id")


def lines_of(cy: np.ndarray, height: np.ndarray, tolerance: Callable[[float, float], float]) -> list[list[int]]:
    """Rows given from top to bottom, as lines: each joins the first line whose mean centre is near
    enough. tolerance: of the row's height and the line's mean height."""
    lines: list[list[int]] = []
    sums: list[list[float]] = []  # of a line: rows, centres, heights
    for i, (y, h) in enumerate(zip(cy.tolist(), height.tolist())):
        at = next((k for k, (n, ys, hs) in enumerate(sums) if abs(y - ys / n) <= tolerance(h, hs / n)), None)
        if at is None:
            lines.append([i])
            sums.append([1, y, h])
        else:
            lines[at].append(i)
            sums[at] = [sums[at][0] + 1, sums[at][1] + y, sums[at][2] + h]
    return lines


def _centers(b: Block, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = b.boxes()
    return (k[:, 0] + k[:, 2]) / 2, (k[:, 1] + k[:, 3]) / 2, np.maximum(k[:, 3] - k[:, 1], least)


def _downwards() -> list[Column]:
    return [F.asc(F.col("box.y1") + F.col("box.y2")), F.asc(F.col("box.x1") + F.col("box.x2")), F.asc("key")]


def reading_order(df: DataFrame, group: str = "group_id") -> DataFrame:
    """df (image_id, group, key, box) with position: rows by their centres' height within 0.6 of the
    upper median height, from left to right in each row."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        x, y, h = _centers(b, 1.0)
        reach = max(0.6 * np.sort(h)[len(h) // 2], 2.0)
        order = [i for line in lines_of(y, h, lambda *_: reach) for i in sorted(line, key=lambda i: x[i])]
        return order, {"position": list(range(1, len(order) + 1))}

    d = df.where("box is not null").withColumn("block_id", F.concat_ws("\u0001", "image_id", group))
    return fold(d, _downwards(), step, "position int").drop("block_id")


def text_lines(df: DataFrame) -> DataFrame:
    """df (image_id, key, box) with line_no and position in it: nodes on one level, by their centres
    within 0.65 of the height, from left to right. Levels need the whole image, so it is one block;
    a task holds the nodes of one image."""

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        x, y, h = _centers(b, 1e-6)
        lines = [sorted(line, key=lambda i: x[i]) for line in lines_of(y, h, lambda own, line: 0.65 * max(own, line))]
        return list(chain.from_iterable(lines)), {"line_no": [n for n, line in enumerate(lines, 1) for _ in line], "position": [p for line in lines for p in range(1, len(line) + 1)]}

    return fold(df.where("box is not null").withColumn("block_id", F.col("image_id")), _downwards(), step, "line_no int, position int").drop("block_id")


def greedy_selection(df: DataFrame, target: int, bonus: dict[str, float] | None = None, cap: int = 2, penalty: float = 0.15, diversity: float = 0.0) -> DataFrame:
    """At most target candidates an image: each pick is the best by quality with a bonus for unread
    text (1.7), an unused question type (1.1) and ``bonus`` by type, less for capped labels used
    ``cap`` times; the first by (-quality, candidate_id) on ties. df: image_id, candidate_id, quality,
    question_type, text_key, label, capped.

    A pick depends on the picks before it, so an image is one block. Only its best candidates of
    each text, type and label can be picked: at most ``target`` of each go into the fold."""
    from pyspark.sql import Window

    extra = {"DIRECT_READ": 0.25} | (bonus or {})

    def step(b: Block) -> tuple[list[int], dict[str, list]]:
        n = len(b)
        if n <= target:
            return list(range(n)), {"pick": list(range(1, n + 1))}
        kinds, texts, labels, capped = b.text("question_type"), b.text("text_key"), b.text("label"), [bool(x) for x in b["capped"]]
        quality = b.number("quality") + np.array([extra.get(k, 0.0) for k in kinds])
        used: dict[str, dict[str, int]] = {"kind": {}, "text": {}, "label": {}}
        left, picked = set(range(n)), []

        def score(i: int) -> tuple[float, int]:
            often = used["label"].get(labels[i], 0)
            gain = 1.7 * (texts[i] not in used["text"]) + 1.1 * (kinds[i] not in used["kind"]) + diversity * (often == 0 and labels[i] != "")
            return quality[i] + gain - penalty * (capped[i] and 0 < cap <= often), -i

        while len(picked) < target:
            i = max(left, key=score)
            left.remove(i)
            picked.append(i)
            for name, value in (("kind", kinds[i]), ("text", texts[i]), ("label", labels[i])):
                used[name][value] = used[name].get(value, 0) + 1
        return picked, {"pick": list(range(1, target + 1))}

    w = Window.partitionBy("image_id", "question_type", "text_key", "label", "capped").orderBy(F.desc("quality"), "candidate_id")
    d = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= target).drop("_r").withColumn("block_id", F.col("image_id"))
    return fold(d, [F.desc("quality"), F.asc("candidate_id")], step, "pick int").drop("block_id")
