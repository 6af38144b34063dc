"""Problem 1: how often every distinct term occurs, and in how many records.

Recursive radix spilling. Each task first combines its own rows, so a term reaches the shuffle at
most once a task and chunk however common it is. The partial counts are then partitioned by the
leading bits of the term's hash (the shuffle writes these partitions to disk). A partition larger
than what one aggregation may hold is split by the next bits into spill files, as often as needed,
and every part is aggregated by DuckDB under a memory limit, which spills to the same folder.

Results for odd input: null keys, null texts and texts without a word give no term; an empty table
gives no rows; a record delivered several times counts once, the delivery with the greatest
``version`` (ties: the greatest text) decides; columns other than the named ones are ignored.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import words
from glyphloom.session import shared_dir, written

PARTIAL = "field_name string, term string, hash long, occurrences long, records long"
COUNTS = "field_name string, term string, occurrences long, records long"
#: A term of no characters can't occur; under this name goes the number of records of a field.
ALL_RECORDS = ""
HASH_BITS = 64
#: Bits of each further split: 16 spill files at once.
SPLIT_BITS = 4
#: Bytes of Arrow data that one aggregation takes; beyond, a partition is split.
PART_BYTES = 64 << 20
#: Bytes of texts that a task combines at once.
CHUNK_BYTES = 16 << 20
DUCKDB_MEMORY = "384MB"


def last_delivery(df: DataFrame, key: str, text: str, version: str) -> DataFrame:
    """(key, text): one row for every non-null key."""
    newest = F.max_by(F.col(text), F.struct(F.col(version), F.col(text)))
    return df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(key).alias("key")).agg(newest.alias("text"))


def word_terms(text: Column) -> Column:
    """Every word of the text is a term."""
    return words(text)


def whole_label(text: Column) -> Column:
    """The label's words joined by single blanks are its only term; none if it has no word."""
    label = F.array_join(words(text), " ")
    return F.when(label != "", F.array(label)).otherwise(F.array().cast("array<string>"))


def records_of(df: DataFrame, field: str, key: str, text: str, version: str, terms=word_terms) -> DataFrame:
    """(field_name, terms): the records of one field that have a term."""
    found = last_delivery(df, key, text, version).select(F.lit(field).alias("field_name"), terms(F.col("text")).alias("terms"))
    return found.where(F.size("terms") > 0)


def _aggregate(table: pa.Table, sql: str, spill: str | None) -> pa.Table:
    import duckdb

    settings = {"threads": 1, "memory_limit": DUCKDB_MEMORY, "preserve_insertion_order": False, "temp_directory": spill or ""}
    with duckdb.connect(config=settings) as db:
        db.register("t", table)
        return db.sql(sql).to_arrow_table()


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of chunks of records: (field_name, term, occurrences, records)."""
    sql = f"""
        WITH r AS (SELECT row_number() OVER () AS id, field_name, terms FROM t),
             w AS (SELECT id, field_name, unnest(terms) AS term FROM r),
             o AS (SELECT field_name, term, id, count(*) AS n FROM w GROUP BY ALL)
        SELECT field_name, term, sum(n)::BIGINT AS occurrences, count(*)::BIGINT AS records FROM o WHERE term <> '' GROUP BY ALL
        UNION ALL SELECT field_name, '{ALL_RECORDS}', 0, count(*)::BIGINT FROM r GROUP BY ALL"""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield from _aggregate(pa.Table.from_batches(held), sql, None).to_batches()
            held, size = [], 0
    if held:
        yield from _aggregate(pa.Table.from_batches(held), sql, None).to_batches()


class _Spill:
    """Arrow files by hash bits in the shared folder, on whatever file system that is."""

    def __init__(self, base: str, schema: pa.Schema):
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(base if "://" in base else f"file://{os.path.abspath(base)}")
        self.root, self.schema, self.open = f"{root}/terms-{uuid.uuid4().hex}", schema, {}
        self.local = self.root if isinstance(self.fs, fs.LocalFileSystem) else None
        self.fs.create_dir(self.root, recursive=True)

    def write(self, name: str, batch: pa.RecordBatch) -> None:
        if name not in self.open:
            out = self.fs.open_output_stream(f"{self.root}/{name}")
            self.open[name] = [out, pa.ipc.new_stream(out, self.schema), 0]
        self.open[name][1].write_batch(batch)
        self.open[name][2] += batch.nbytes

    def finish(self, prefix: str) -> list[tuple[str, int]]:
        done = [(name, self.open.pop(name)) for name in sorted(self.open) if name.startswith(prefix)]
        for _, (out, writer, _) in done:
            writer.close()
            out.close()
        return [(name, size) for name, (_, _, size) in done]

    def read(self, name: str) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_stream(f"{self.root}/{name}") as f, pa.ipc.open_stream(f) as batches:
            yield from batches
        self.fs.delete_file(f"{self.root}/{name}")

    def remove(self) -> None:
        if self.local:
            shutil.rmtree(self.local, ignore_errors=True)
        else:
            self.fs.delete_dir(self.root)


def radix_aggregate(batches: Iterator[pa.RecordBatch], base: str, depth: int, part_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Sums the partial counts of one radix partition, whose terms agree in ``depth`` hash bits.

    Holds at most part_bytes and one spill buffer; what exceeds it is split by the next SPLIT_BITS
    bits, recursively, until the parts fit or the bits are used up (then all rows are of one term or of
    colliding ones, and are summed batch by batch). DuckDB may spill to the same folder if that is local;
    elsewhere the parts fit its memory.
    """
    sql = "SELECT field_name, term, sum(occurrences)::BIGINT AS occurrences, sum(records)::BIGINT AS records FROM t GROUP BY ALL"
    names = [c.split()[0] for c in COUNTS.split(", ")]
    spill: _Spill | None = None

    def split(rows: Iterator[pa.RecordBatch], name: str, depth: int) -> list[tuple[str, int]]:
        import numpy as np

        for b in rows:
            part = (b.column("hash").to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(HASH_BITS - depth - SPLIT_BITS)) & np.uint64((1 << SPLIT_BITS) - 1)
            for p in np.unique(part):
                spill.write(f"{name}.{int(p):x}", b.filter(pa.array(part == p)))
        return spill.finish(f"{name}.")

    def solve(name: str, size: int, depth: int) -> Iterator[pa.RecordBatch]:
        if size > part_bytes and depth + SPLIT_BITS > HASH_BITS:
            # one term, or few whose hashes are the same: batch by batch, so that little is ever held
            sums = pa.Table.from_batches([], spill.schema).select(names)
            for b in spill.read(name):
                both = pa.concat_tables([sums, pa.Table.from_batches([b]).select(names)])
                sums = _aggregate(both, sql, spill.local).cast(sums.schema)
            yield from sums.to_batches()
        elif size <= part_bytes:
            yield from _aggregate(pa.Table.from_batches(spill.read(name), spill.schema), sql, spill.local).to_batches()
        else:
            for child, n in split(spill.read(name), name, depth):
                yield from solve(child, n, depth + SPLIT_BITS)

    held: list[pa.RecordBatch] = []
    size = 0
    try:
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > part_bytes:
                spill = _Spill(base, batch.schema)

                def rest() -> Iterator[pa.RecordBatch]:
                    while held:
                        yield held.pop()
                    yield from batches

                for child, n in split(rest(), "p", depth):
                    yield from solve(child, n, depth + SPLIT_BITS)
        if held:
            yield from _aggregate(pa.Table.from_batches(held), sql, None).to_batches()
    finally:
        if spill:
            spill.remove()


def term_frequencies(records: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(field_name, term, occurrences, records, total_records) of records (field_name, terms).

    The result is a table written in the shared folder; total_records are the field's records.
    """
    spark = records.sparkSession
    base = shared_dir(spark)
    combined = records.mapInArrow(_combine, COUNTS).withColumn("hash", F.xxhash64("field_name", "term"))
    bits = max(0, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    radix = F.shiftrightunsigned("hash", HASH_BITS - bits).cast("int") if bits else F.lit(0)
    parts = combined.select("field_name", "term", "hash", "occurrences", "records").repartitionById(1 << bits, radix)
    counts = written(parts.mapInArrow(lambda batches: radix_aggregate(batches, base, bits, part_bytes), COUNTS), "terms")
    # one row a field
    totals = counts.where(F.col("term") == ALL_RECORDS).select("field_name", F.col("records").alias("total_records"))
    return counts.where(F.col("term") != ALL_RECORDS).join(F.broadcast(totals), "field_name")


def marked(frequencies: DataFrame, rare_below: int = 3, common_above: float = 0.05) -> DataFrame:
    """Adds mark: rare if fewer records than rare_below hold the term, else common if more than
    the share common_above of the field's records do, else null."""
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.col("total_records") * F.lit(common_above), "common")
    return frequencies.withColumn("mark", mark)
