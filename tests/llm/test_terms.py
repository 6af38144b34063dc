from __future__ import annotations

import random
from collections import Counter, defaultdict

import pyarrow as pa
from glyphloom.llm import terms


def counted(df):
    return {(r.field_name, r.term): (r.occurrences, r.records, r.total_records) for r in df.collect()}


def test_counts_deliveries_once_and_words_each(spark):
    rows = [("a", "Red red, BUS", 1, 9), ("a", "Red red, BUS", 2, 9), ("b", "bus", 1, 9), ("c", None, 1, 9), (None, "bus", 1, 9), ("d", " ?! ", 1, 9), ("e", "", 1, 9)]
    df = spark.createDataFrame(rows, "id string, text string, v int, term int")  # term: a clashing name
    got = counted(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v")))
    assert got == {("f", "red"): (2, 1, 2), ("f", "bus"): (2, 2, 2)}


def test_latest_delivery_decides(spark):
    df = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "old", None), ("b", "newer", 0)], "id string, text string, v int")
    got = counted(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v")))
    assert set(got) == {("f", "new"), ("f", "newer")}


def test_whole_label_is_one_term(spark):
    df = spark.createDataFrame([("a", "Top-Left  Area", 1), ("b", "top left area!", 1), ("c", "--", 1)], "id string, text string, v int")
    got = counted(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v", terms.whole_label)))
    assert got == {("f", "top left area"): (2, 2, 2)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string, text string, v int")
    assert terms.marked(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v"))).collect() == []


def test_marks(spark):
    rows = [(str(i), "the " + ("w%d" % (i // 5)) + (" odd" if i == 7 else ""), 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, text string, v int")
    got = {r.term: r.mark for r in terms.marked(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v"))).collect()}
    assert got["the"] == "common" and got["odd"] == "rare" and got["w3"] is None


def test_hot_term_and_spilling_against_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(str(i), " ".join(["hot"] + [f"t{rnd.randrange(4000)}" for _ in range(rnd.randrange(6))]), 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "id string, text string, v int")
    got = counted(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v"), part_bytes=2000))
    occurrences, records = Counter(), defaultdict(set)
    for i, text, _ in rows:
        for w in text.split():
            occurrences[w] += 1
            records[w].add(i)
    assert got == {("f", w): (n, len(records[w]), len(rows)) for w, n in occurrences.items()}


def test_radix_splits_recursively_and_cleans_up(tmp_path):
    schema = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("hash", pa.int64()), ("occurrences", pa.int64()), ("records", pa.int64())])
    # hashes that agree in their leading bits, so that one split is not enough; and one term of colliding hash
    rows = [{"field_name": "f", "term": f"t{i % 500}", "hash": (5 << 52) | (i % 500), "occurrences": 1, "records": 1} for i in range(3000)]
    batches = pa.Table.from_pylist(rows, schema=schema).to_batches(max_chunksize=100)
    out = pa.Table.from_batches(list(terms.radix_aggregate(iter(batches), str(tmp_path), 0, part_bytes=3000))).to_pylist()
    assert len(out) == 500 and all(r["occurrences"] == 6 and r["records"] == 6 for r in out)
    assert list(tmp_path.iterdir()) == []


def test_colliding_hashes_are_summed_batch_by_batch(tmp_path):
    schema = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("hash", pa.int64()), ("occurrences", pa.int64()), ("records", pa.int64())])
    rows = [{"field_name": "f", "term": f"t{i % 3}", "hash": 77, "occurrences": 2, "records": 1} for i in range(600)]
    batches = pa.Table.from_pylist(rows, schema=schema).to_batches(max_chunksize=50)
    out = pa.Table.from_batches(list(terms.radix_aggregate(iter(batches), str(tmp_path), 0, part_bytes=1000))).to_pylist()
    assert sorted((r["term"], r["occurrences"], r["records"]) for r in out) == [(f"t{k}", 400, 200) for k in range(3)]
    assert list(tmp_path.iterdir()) == []


def test_very_long_text(spark):
    df = spark.createDataFrame([("a", "word " * 200_000 + "end", 1)], "id string, text string, v int")
    got = counted(terms.term_frequencies(terms.records_of(df, "f", "id", "text", "v")))
    assert got == {("f", "word"): (200_000, 1, 1), ("f", "end"): (1, 1, 1)}
