"""Problem 3: records that differ only in format become one record, with the number of copies.

Byte-identical rows are collapsed first, with counts; only the distinct survivors are brought to
their canonical form; a second grouping on the full canonical text sums the counts. Membership
(which key went into which group) is won by two joins back, each with one row a key on the right
and heavy keys met by broadcast, so a text that holds a third of all rows stays spread over tasks.

Results for odd input: a record is a non-null key; of several deliveries with different fields the
greatest field values count; records with a null in a field take no part, nor do those whose
``filled`` field has no letter or digit; a payload takes part if it is one complete JSON object with
all five fields; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import alike_key
from glyphloom.operators.skew import HEAVY_ROWS, HEAVY_SHARE, lookup_join
from glyphloom.session import written

JSON_FIELDS = ("image_id", "question", "answer", "question_type", "answer_normalized")


@dataclass(frozen=True)
class Identity:
    """Fields that must be equal as they are, fields that must be alike, and the one that mustn't be blank."""

    exact: tuple[str, ...]
    alike: tuple[str, ...]
    filled: str | None = None


def json_fields(df: DataFrame, key: str, payload: str, fields: tuple[str, ...] = JSON_FIELDS) -> DataFrame:
    """(key, fields...) of the payloads that are one complete JSON object."""
    schema = ", ".join(f"`{f}` string" for f in fields) + ", `_broken` string"
    whole = df.where(F.btrim(F.regexp_replace(payload, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")).rlike(r"(?s)^\{.*\}$"))
    parsed = whole.select(F.col(key), F.from_json(payload, schema, {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}).alias("p"))
    return parsed.where("p is not null and p._broken is null").select(F.col(key), *(F.col("p").getField(f).alias(f) for f in fields))


def _heavy(groups: DataFrame, size: str, keys: list[str]) -> DataFrame:
    """At most 1 / HEAVY_SHARE groups: those with that share of the rows that their sizes count."""
    bound = groups.agg(F.greatest(F.sum(size) * F.lit(HEAVY_SHARE), F.lit(float(HEAVY_ROWS))).alias("_least"))
    return groups.join(F.broadcast(bound), F.col(size) >= F.col("_least")).select(*keys)


@dataclass(frozen=True)
class Collapsed:
    """The steps of a collapse, each a written table."""

    records: DataFrame  # key, r0.. (raw fields)
    survivors: DataFrame  # r0.., c0.. (canonical), copies, first_key
    groups: DataFrame  # c0.., copies, forms, kept_key


def collapse(df: DataFrame, key: str, identity: Identity) -> Collapsed:
    fields = [*identity.exact, *identity.alike]
    raw, canon = [f"r{i}" for i in range(len(fields))], [f"c{i}" for i in range(len(fields))]
    named = df.select(F.col(key).alias("key"), *(F.col(f).alias(r) for f, r in zip(fields, raw)))
    present = named.where(" and ".join(f"{c} is not null" for c in ["key", *raw]))
    if identity.filled:
        present = present.where(F.col(raw[fields.index(identity.filled)]).rlike(r"[\p{L}\p{N}]"))
    # deliveries of one key become one record; identical ones combine before the shuffle
    records = written(present.groupBy("key").agg(F.max(F.struct(*raw)).alias("r")).select("key", "r.*"), "records")
    survivors = records.groupBy(*raw).agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("first_key"))
    keys = [F.col(r).alias(c) if i < len(identity.exact) else alike_key(F.col(r)).alias(c) for i, (r, c) in enumerate(zip(raw, canon))]
    survivors = written(survivors.select(*raw, *keys, "copies", "first_key"), "survivors")
    groups = survivors.groupBy(*canon).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("forms"), F.min("first_key").alias("kept_key"))
    return Collapsed(records, survivors, written(groups, "groups"))


def collapsed_records(c: Collapsed) -> DataFrame:
    """(kept_key, copies, forms): one row for every record left, with the number of records it
    stands for and of their byte-wise different forms."""
    return c.groups.select("kept_key", "copies", "forms")


def copy_pairs(c: Collapsed) -> DataFrame:
    """(kept_key, copy_key): the smallest key of each group of copies with every other one."""
    canon = [x for x in c.groups.columns if x[0] == "c" and x[1:].isdigit()]
    raw = [x for x in c.records.columns if x != "key"]
    several = c.groups.where("copies > 1")
    forms = lookup_join(c.survivors, several.select(*canon, "kept_key"), canon, heavy=_heavy(several, "forms", canon))
    forms = forms.select(*raw, "kept_key")
    pairs = lookup_join(c.records, forms, raw, heavy=_heavy(c.survivors, "copies", raw))
    return pairs.where("key <> kept_key").select("kept_key", F.col("key").alias("copy_key"))
