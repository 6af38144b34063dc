from __future__ import annotations

import json
import random
import re
from collections import defaultdict

from glyphloom.llm import copies
from glyphloom.llm.copies import Identity, collapse, collapsed_records, copy_pairs

IDENTITY = Identity(("img",), ("q", "a"), "a")
SCHEMA = "id string, img string, q string, a string, key string, r0 string"


def like(s):
    return re.sub(r"[\W_]+", "", s.lower())


def pairs(df, key="id", identity=IDENTITY):
    return sorted((r.kept_key, r.copy_key) for r in copy_pairs(collapse(df, key, identity)).collect())


def rows(*given):
    return [(*g, "clash", "clash") for g in given]


def test_format_only(spark):
    df = spark.createDataFrame(rows(("2", "i", "What is it?", "STOP"), ("1", "i", "what  is IT", "stop!"), ("3", "j", "What is it?", "STOP"), ("4", "i", "What is it", "stop it")), SCHEMA)
    assert pairs(df) == [("1", "2")]
    kept = {r.kept_key: (r.copies, r.forms) for r in collapsed_records(collapse(df, "id", IDENTITY)).collect()}
    assert kept == {"1": (2, 2), "3": (1, 1), "4": (1, 1)}


def test_what_takes_no_part(spark):
    given = rows((None, "i", "q", "a"), ("1", None, "q", "a"), ("2", "i", None, "a"), ("3", "i", "q", None), ("4", "i", "q", " ?!"), ("5", "i", "q", ""), ("6", "i", "", "a"), ("7", "i", "--", "A"))
    assert pairs(spark.createDataFrame(given, SCHEMA)) == [("6", "7")]


def test_a_key_is_one_record(spark):
    df = spark.createDataFrame(rows(("1", "i", "q", "a"), ("1", "i", "q", "a"), ("2", "i", "Q", "a"), ("2", "i", "Q", "a"), ("3", "i", "q", "a"), ("3", "i", "zzz", "a")), SCHEMA)
    assert pairs(df) == [("1", "2")]  # 3 counts with its greatest fields


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pairs(df) == [] and collapsed_records(collapse(df, "id", IDENTITY)).collect() == []


def test_hot_group_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(copies, "HEAVY_ROWS", 50)
    rnd = random.Random(2)
    given = [(f"k{i:05d}", "i", rnd.choice(["Hot one", "hot ONE", "hot-one"]), "yes") if i % 3 == 0 else (f"k{i:05d}", f"i{rnd.randrange(40)}", rnd.choice("aAbB") + rnd.choice(" -"), rnd.choice(["No", "no."])) for i in range(3000)]
    groups = defaultdict(list)
    for k, img, q, a in given:
        groups[img, like(q), like(a)].append(k)
    want = sorted((min(g), k) for g in groups.values() for k in g if k != min(g))
    assert pairs(spark.createDataFrame(rows(*given), SCHEMA).repartition(6)) == want


def test_payloads(spark):
    whole = {"image_id": "i1", "question": "What?", "answer": "A b", "question_type": "X_Y", "answer_normalized": "a b"}
    other = {k: whole[k].upper() for k in reversed(whole)}
    texts = [json.dumps(whole), "  " + json.dumps(other, indent=2) + "\n", json.dumps(whole)[:-1], json.dumps(whole)[:40], None, "", "[]", json.dumps({k: v for k, v in whole.items() if k != "answer"}), json.dumps(whole | {"answer": None}), "null", "{}", json.dumps(whole | {"answer": "a }"}), json.dumps(whole | {"more": 1})]
    df = spark.createDataFrame([(f"r{i:02d}", t) for i, t in enumerate(texts)], "rid string, payload string")
    fields = copies.json_fields(df, "rid", "payload")
    assert pairs(fields, "rid", Identity((), copies.JSON_FIELDS)) == [("r00", "r01"), ("r00", "r12")]
