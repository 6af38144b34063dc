"""Problem 7: texts into containers of fixed capacity, by harmonic packing.

Sizes are counted in tokens of a public tokenizer. A text longer than the capacity, and only such a
one, is cut into parts of exactly the capacity and a rest. The parts are spread over workers by
hash; each worker packs its own without regard to the others. A size in (C / (k + 1), C / k] is of
class k, and k of a class fill a container. Sizes of at most C / classes form the last class: they
first fill what the other containers have left, best fit first, then containers of their own.

Results for odd input: null texts and texts without a token are in no container; repeated texts
under other ids are packed each; rows with a null id are left out; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.session import ship, written

CAPACITY = 4096
#: Numbers of classes to try; each worker keeps what needs the fewest containers.
CLASSES = (4, 8, 16)
#: Items a worker packs at once, in one task's memory.
WORKER_ITEMS = 50_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that splits texts before the merges of the rank file (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space longer than this is counted as the one piece that the pattern makes of it, without the
#: pattern, whose engine would run out of stack.
LONG_SPACE = 20_000
#: White space as the pattern's engine has it.
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The setting that names the rank file on the driver; tasks get its content.
TOKENIZER_SETTING = "spark.glyphloom.tokenizer"
#: A rank file larger than this is refused: it is sent to every worker.
RANK_BYTES = 64 << 20

_encodings: dict = {}


def encoding_of(ranks: bytes, pattern: str = PATTERN):
    """The encoding of a rank file's content; one per Python worker."""
    key = (hash(ranks), pattern)
    if key not in _encodings:
        import base64

        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings.clear()
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encodings[key]


def count_tokens(encoding, text: str | None, long_space: int = LONG_SPACE) -> int:
    """As many as encoding the whole text gives.

    The pattern takes white space before a word as one piece but for its last character, and white space
    at the end as one piece; so a text can be cut there."""
    n = at = 0
    for m in re.finditer(f"{SPACE}{{{long_space},}}", text or ""):
        end = m.end() if m.end() == len(text) else m.end() - 1
        n += len(encoding.encode_ordinary(text[at : m.start()])) + len(encoding._encode_single_piece(text[m.start() : end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:] if at else text or ""))


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """(key, tokens) of every row with a key. tokenizer: a rank file on the driver; by default the one that
    the session's setting names."""
    spark = df.sparkSession
    ship(spark)
    path = tokenizer or spark.conf.get(TOKENIZER_SETTING, TOKENIZER)
    if os.path.getsize(path) > RANK_BYTES:
        raise ValueError(f"{path} has more than {RANK_BYTES} bytes")
    with open(path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of(sent.value, pattern)
        for b in batches:
            n = [count_tokens(encoding, t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["key", "tokens"])

    return df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), text).mapInArrow(count, "key long, tokens long")


def parts_of(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, part, first_token, tokens): texts in one part if they fit, else in full parts and a rest."""
    last = F.expr(f"(tokens - 1) div {capacity}")
    parts = counts.where("tokens > 0").select("key", F.col("tokens").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    first = F.col("part") * capacity
    return parts.select("key", "part", first.alias("first_token"), F.least(F.col("n") - first, F.lit(capacity)).alias("tokens"))


def pack_sizes(sizes: np.ndarray, capacity: int = CAPACITY, classes: tuple[int, ...] = CLASSES) -> np.ndarray:
    """The container of every size, numbered from 0; sizes lie in 1..capacity."""
    return min((pack_classes(sizes, capacity, n) for n in classes), key=lambda bins: bins.max(initial=-1))


def pack_classes(sizes: np.ndarray, capacity: int, classes: int) -> np.ndarray:
    bins = np.full(len(sizes), -1, dtype=np.int64)
    kind = np.minimum(capacity // np.maximum(sizes, 1), classes)
    used, free = 0, []
    for k in range(1, classes):
        members = np.flatnonzero(kind == k)
        members = members[np.argsort(-sizes[members], kind="stable")]
        at = np.arange(len(members)) // k
        bins[members] = used + at
        n = int(at[-1]) + 1 if len(at) else 0
        free.append(capacity - np.bincount(at, weights=sizes[members], minlength=n).astype(np.int64))
        used += n
    # containers by free space; the set bits of mask tell which sizes of space there are
    spaces: dict[int, list[int]] = {}
    mask = 0
    for i, space in enumerate(np.concatenate(free).tolist() if free else []):
        spaces.setdefault(space, []).append(i)
        mask |= 1 << space
    small = np.flatnonzero(kind == classes)
    small = small[np.argsort(-sizes[small], kind="stable")]
    for i, size in zip(small.tolist(), sizes[small].tolist()):
        fits = mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = spaces[space].pop()
            if not spaces[space]:
                mask &= ~(1 << space)
        else:
            b, space, used = used, capacity, used + 1
        bins[i] = b
        spaces.setdefault(space - size, []).append(b)
        mask |= 1 << (space - size)
    return bins


def pack(parts: DataFrame, capacity: int = CAPACITY, classes: tuple[int, ...] = CLASSES, worker_items: int = WORKER_ITEMS) -> DataFrame:
    """(container_id, key, part, first_token, tokens) of parts, which must be a written table."""
    workers = max(1, math.ceil(parts.count() / worker_items))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "part"], ignore_index=True)
        bins = pack_sizes(group["tokens"].to_numpy(), capacity, classes)
        return group.assign(container_id=group["worker"].to_numpy() * (1 << 32) + bins)[["container_id", "key", "part", "first_token", "tokens"]]

    spread = parts.withColumn("worker", F.pmod(F.xxhash64("key", "part"), F.lit(workers)))
    return spread.groupBy("worker").applyInPandas(one, "container_id long, key long, part long, first_token long, tokens long")


def packed(df: DataFrame, key: str, text: str, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(written(parts_of(token_counts(df, key, text, tokenizer), capacity), "parts"), capacity)


def split_keys(containers: DataFrame) -> DataFrame:
    """(key): the texts that lie in more than one part, that is, exceed the capacity."""
    return containers.where("part = 1").select("key")


def fill(containers: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, tokens, fill_share): one row; how full the containers are."""
    each = containers.groupBy("container_id").agg(F.sum("tokens").alias("tokens"))
    n, tokens = F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0))
    return each.agg(n.alias("containers"), tokens.alias("tokens"), F.when(n > 0, tokens / (n * capacity)).alias("fill_share"))


def audit(containers: DataFrame, capacity: int = CAPACITY, least_fill: float = 0.97) -> DataFrame:
    """One row: the texts in containers; how many containers hold more than fits, texts are in parts though
    they would fit, texts lack tokens or have some twice; and whether the containers are full enough: no more of them than
    the tokens need at a fill of least_fill, but for one that each worker leaves open."""
    held = written(containers, "containers")
    n = lambda c: F.count(F.when(c, 1))
    loads = held.groupBy("container_id").agg(F.sum("tokens").alias("load"))
    loads = loads.agg(n(F.col("load") > capacity).alias("over_capacity"), F.count(F.lit(1)).alias("containers"), F.count_distinct(F.shiftright("container_id", 32)).alias("workers"))
    ends = F.max(F.col("first_token") + F.col("tokens"))
    texts = held.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max("part").alias("last"), F.count_distinct("first_token").alias("starts"), F.sum("tokens").alias("tokens"), ends.alias("end"))
    texts = texts.agg(F.count(F.lit(1)).alias("documents"), n((F.col("parts") > 1) & (F.col("end") <= capacity)).alias("split_needlessly"), n((F.col("parts") != F.col("last") + 1) | (F.col("parts") != F.col("starts")) | (F.col("tokens") != F.col("end"))).alias("incomplete"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    load, text = loads.first(), texts.first()
    full = text["tokens"] >= least_fill * (load["containers"] - load["workers"]) * capacity
    row = (text["documents"], load["over_capacity"], text["split_needlessly"], text["incomplete"], full)
    return held.sparkSession.createDataFrame([row], "documents long, over_capacity long, split_needlessly long, incomplete long, full boolean")
