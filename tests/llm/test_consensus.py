from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from glyphloom.llm import align
from glyphloom.llm import consensus as c

T0 = datetime(2025, 1, 1)
SCHEMA = "image_id string, node_id string, model_name string, text string, confidence double, read_at timestamp, reader string, band string, probability int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(old + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def slips(texts, left, right, cells=align.CELLS):
    """(a, b) of each pair's slips, the characters or None."""
    pair, a, b = align.slips(align.Texts(texts), np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), cells)
    out = [[] for _ in left]
    for p, x, y in zip(pair.tolist(), a.tolist(), b.tolist()):
        out[p].append((chr(x) if x >= 0 else None, chr(y) if y >= 0 else None))
    return out


@pytest.mark.parametrize("cells", [3, 60, align.CELLS])
def test_alignments_are_least(cells):
    rnd = random.Random(9)
    texts = ["".join(rnd.choices("abc1é", k=rnd.randrange(k))) for k in (2, 5, 12, 30) for _ in range(40)]
    pairs = [(rnd.randrange(160), rnd.randrange(160)) for _ in range(300)]
    for (i, j), found in zip(pairs, slips(texts, *zip(*pairs), cells)):
        a, b = texts[i], texts[j]
        assert len(found) == distance(a, b) and all(x != y for x, y in found)
        # the slips turn the characters of one into those of the other
        left = Counter(a)
        left.subtract(Counter(x for x, _ in found if x))
        left.update(Counter(y for _, y in found if y))
        assert +left == Counter(b)


def test_every_script_has_codes():
    coder = c.Coder(np.array([ord("б"), ord("a")]))
    assert coder.codes(np.array([ord("a"), ord("б"), ord("z"), -1])).tolist() == [c.FIRST + 1, c.FIRST, c.OTHER, c.NONE]


def test_latest_reading_counts_and_must_be_usable(spark):
    later = T0 + timedelta(hours=1)
    rows = [("i", "n", "a", "Old", 0.9, T0), ("i", "n", "a", "NEW!", 0.9, later), ("i", "n", "b", "new", 90.0, T0), ("i", "n", "b", "new", 90.0, T0), ("i", "n", "c", "seen", 0.9, T0), ("i", "n", "c", " ?", None, later), ("i", "m", "a", "***", 0.9, T0), ("i", "m", "b", None, 0.9, T0), (None, "n", "a", "x", 0.9, T0), ("i", None, "a", "x", 0.9, T0), ("i", "k", None, "  A \t b ", float("nan"), None)]
    votes = sorted((r.node_id, r.reader, r.text, r.band) for r in c.votes(table(spark, rows)).collect())
    assert votes == [("k", "", "a b", 0), ("n", "a", "new", 4), ("n", "b", "new", 4)]
    found = {(r.image_id, r.node_id): r for r in c.consensus(table(spark, rows)).found().collect()}
    assert {k: v.text_normalized for k, v in found.items()} == {("i", "n"): "new", ("i", "k"): "a b"}
    assert found["i", "n"].agreeing == 1.0 and found["i", "k"].agreeing is None


def test_no_readings(spark):
    got = c.consensus(table(spark, []))
    assert got.found().collect() == [] and got.reliability().collect() == []
    assert c.chance_corrected(table(spark, [])).first().alpha is None


def simulated(seed, nodes):
    """Three fair readers, one that confuses o and l with digits, and a pair that copies it badly."""
    rnd = random.Random(seed)
    letters = "abcdefghiklmnoprstuvz"
    truth, rows = {}, []
    for n in range(nodes):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randrange(4, 9)))
        truth[f"n{n}"] = word

        def slip(w, rate, habits=()):
            w = "".join(dict(habits).get(x, x) if rnd.random() < 0.7 else x for x in w)
            return "".join(rnd.choice(letters) if rnd.random() < rate else x for x in w)

        bad = slip(word, 0.08, (("o", "0"), ("l", "1"), ("i", "l"), ("s", "5")))
        seen = {"fair1": slip(word, 0.01), "fair2": slip(word, 0.02), "fair3": slip(word, 0.04), "habit": slip(word, 0.02, (("o", "0"), ("l", "1"))), "bad": bad, "copy": bad if rnd.random() < 0.95 else slip(word, 0.1)}
        for r, text in seen.items():
            if rnd.random() < 0.8:
                rows.append(("i" if n % 3 else "hot", f"n{n}", r, text, rnd.random(), T0))
    return truth, rows


def test_beats_the_majority_and_knows_its_readers(spark):
    truth, rows = simulated(1, 900)
    got = c.consensus(table(spark, rows))
    right = sum(truth[r.node_id] == r.text_normalized for r in got.found().collect())
    votes = {}
    for _, n, _, text, *_ in rows:
        votes.setdefault(n, Counter())[text] += 1
    majority = sum(max(sorted(v), key=v.get) == truth[n] for n, v in votes.items())
    assert right > majority + 40 and right > 0.93 * len(votes)
    by = {r.reader: r for r in got.reliability().collect()}
    assert min(by[f"fair{i}"].reliability for i in (1, 2, 3)) > by["habit"].reliability > by["bad"].reliability
    assert by["bad"].most_alike == "copy" and by["bad"].copied_share > 0.7
    alpha = c.chance_corrected(table(spark, rows)).first()
    assert 0 < alpha.alpha < alpha.observed < 1


def test_results_do_not_depend_on_order(spark):
    _, rows = simulated(2, 120)
    a = sorted(map(str, c.consensus(table(spark, rows)).found().collect()))
    random.Random(3).shuffle(rows)
    b = sorted(map(str, c.consensus(table(spark, rows + rows[:50]).repartition(3)).found().collect()))
    assert [x.split("probability")[0] for x in a] == [x.split("probability")[0] for x in b]


def test_very_long_text(spark):
    rows = [("i", "n", "a", "x" * 20_000 + "y", 0.9, T0), ("i", "n", "b", "z" + "x" * 20_000, 0.9, T0), ("i", "n", "c", "q" * 3000 + "x" * 1000, 0.9, T0)]
    assert c.consensus(table(spark, rows)).found().count() == 1


def test_long_texts_are_aligned_by_halves():
    long = "".join(random.Random(9).choices("abcdefgh", k=3000))
    (found,) = slips(["x" + long + "y", long[:1500] + "z" + long[1500:]], [0], [1], 1000)
    assert sorted(found, key=str) == sorted([("x", None), (None, "z"), ("y", None)], key=str)


def test_slips_of_a_vote_and_a_text(spark):
    """What a batch holds for every vote and other text of its node, against a plain restatement."""
    rnd = random.Random(4)
    rows = [(f"i{n % 7}", f"n{n}", f"r{r}", "".join(rnd.choices("abcdéßж", k=rnd.randrange(1, 6))), 0.9, T0) for n in range(60) for r in range(rnd.randrange(1, 6))]
    got = c.consensus(table(spark, rows), rounds=1)
    coder = c.Coder(c.alphabet_of(c.votes(table(spark, rows)), 5))
    for f in got.nodes.toArrow().to_batches():
        b = c.Batch(f)
        texts = f.column("texts").flatten().to_pylist()
        for k in range(len(b.pair_vote)):
            seen, true = texts[b.vote_text[b.pair_vote[k]]], texts[b.pair_text[k]]
            mine = b.pair == k
            assert b.slips[k] == mine.sum() == distance(true, seen) and b.same[k] == (true == seen)
            code = lambda s: Counter(coder.codes(np.array([ord(x) for x in s])).tolist())
            left = code(true)
            left.subtract(Counter(x for x in b.a[mine].tolist() if x))
            left.update(Counter(x for x in b.b[mine].tolist() if x))
            assert +left == code(seen)
