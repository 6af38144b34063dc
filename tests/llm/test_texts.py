"""Packing, leakage and repetition."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from glyphloom.llm import leakage, packing, repetition
from glyphloom.llm.fmindex import FMIndex, suffix_array
from hypothesis import given, settings
from hypothesis import strategies as st

DOCS = "doc_id long, text string, words string, tokens int, item_id long, part int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 7, 3) for i, t in rows], DOCS)


# packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200), st.integers(2, 20))
def test_pack_sizes(sizes, classes):
    s = np.array(sizes, dtype=np.int64)
    bins = packing.pack_sizes(s, 100, (classes,))
    load = Counter()
    for b, n in zip(bins.tolist(), sizes):
        load[b] += n
    assert all(n <= 100 for n in load.values()) and len(bins) == len(sizes) and (bins >= 0).all()
    assert set(load) == set(range(len(load)))


def test_little_space_is_left():
    rnd = np.random.default_rng(0)
    sizes = np.clip(rnd.lognormal(5.8, 0.7, 20_000).astype(int), 1, 4096)
    bins = packing.pack_sizes(sizes)
    assert sizes.sum() / ((bins.max() + 1) * 4096) > 0.97


def test_containers(spark):
    rows = [(1, "one two three"), (2, None), (3, ""), (4, "one two three"), (5, "word " * 9000), (None, "x"), (6, " \n\t ")]
    out = packing.packed(docs(spark, rows), "doc_id", "text").collect()
    counts = {r.key: r.tokens for r in packing.token_counts(docs(spark, rows), "doc_id", "text").collect()}
    assert set(counts) == {1, 2, 3, 4, 5, 6} and counts[2] == counts[3] == 0
    per = Counter()
    for r in out:
        per[r.container_id] += r.tokens
    assert max(per.values()) <= packing.CAPACITY
    parts = sorted((r.key, r.part, r.first_token, r.tokens) for r in out)
    assert [p[:2] for p in parts] == [(1, 0), (4, 0), (5, 0), (5, 1), (5, 2), (6, 0)]
    assert sum(p[3] for p in parts if p[0] == 5) == counts[5] and parts[2][3] == packing.CAPACITY
    assert [r.key for r in packing.split_keys(packing.packed(docs(spark, rows), "doc_id", "text")).collect()] == [5]
    assert packing.packed(docs(spark, []), "doc_id", "text").collect() == []
    assert packing.fill(packing.packed(docs(spark, []), "doc_id", "text")).first() == (0, 0, None)


def test_long_white_space_counts_as_in_the_whole_text():
    with open(packing.TOKENIZER, "rb") as f:
        e = packing.encoding_of(f.read())
    rnd = random.Random(2)
    for _ in range(200):
        t = "".join(rnd.choice(["a", " ", "\n", "\u3000", "\x1c", ".", "1", "ab ", " " * rnd.randrange(12), "\n" * rnd.randrange(9)]) for _ in range(rnd.randrange(30)))
        assert packing.count_tokens(e, t, 3) == len(e.encode_ordinary(t))
    assert packing.count_tokens(e, "a" + " " * 2_000_000 + "b" + "\n" * 1_000_000) > 100_000


def test_audit_sees_what_is_wrong(spark):
    fields = "container_id long, key long, part long, first_token long, tokens long"
    good = [(1, 1, 0, 0, 10), (1, 2, 0, 0, 90), (2, 3, 0, 0, 100), (3, 3, 1, 100, 99)]
    assert tuple(packing.audit(spark.createDataFrame(good, fields), 100).first()) == (3, 0, 0, 0, True)
    # 150 tokens fill two containers at the least and may leave a third open, but here are four
    bad = [(1, 1, 0, 0, 50), (1, 2, 0, 0, 60), (2, 3, 0, 0, 10), (3, 3, 1, 10, 10), (4, 4, 1, 100, 20)]
    assert tuple(packing.audit(spark.createDataFrame(bad, fields), 100).first()) == (4, 1, 1, 1, False)
    assert tuple(packing.audit(spark.createDataFrame([], fields), 100).first()) == (0, 0, 0, 0, True)


def test_workers_are_spread(spark):
    parts = spark.range(3000).selectExpr("id as key", "0L as part", "0L as first_token", "1 + id % 300 as tokens")
    out = packing.pack(parts, 1000, worker_items=200).collect()
    assert len(out) == 3000 and len({r.container_id >> 32 for r in out}) == 15
    assert packing.fill(packing.pack(parts, 1000, worker_items=200), 1000).first().fill_share > 0.95


# the index


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=30), min_size=1, max_size=8), st.lists(st.lists(st.sampled_from("abcde"), min_size=2, max_size=2), min_size=1, max_size=10))
def test_index_finds_all_and_only(texts, phrases):
    index = FMIndex(texts)
    rows = np.array([index.numbers(p) for p in phrases])
    phrase, text, at = index.occurrences(rows)
    got = sorted(zip(phrase.tolist(), text.tolist(), at.tolist()))
    assert got == sorted((k, d, i) for k, p in enumerate(phrases) for d, t in enumerate(texts) for i in range(len(t) - 1) if t[i : i + 2] == p)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=200))
def test_suffix_array(text):
    t = np.array([*text, 0])
    assert suffix_array(t, 4).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


# leakage


def held_pairs(rows, items, least=0.5, run=4):
    find = re.compile(r"[^\W_]+").findall
    out = {}
    for d, text in rows:
        if d is None or text is None:
            continue
        w = find(text.lower())
        grams = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}
        for k, item in items:
            q = find((item or "").lower())
            if q and len(q) < run:
                found = any(w[i : i + len(q)] == q for i in range(len(w) - len(q) + 1))
                held = set(range(len(q))) if found else set()
            else:
                held = {i + j for i in range(len(q) - run + 1) if tuple(q[i : i + run]) in grams for j in range(run)}
            if held and len(held) >= least * len(q):
                out[d, k] = len(held)
    return out


def text_of(rnd, n, words=60):
    return " ".join(f"W{rnd.randrange(words)}{rnd.choice(['', ',', '.'])}" for _ in range(n))


@pytest.mark.parametrize("shard", [1 << 20, 50, 7])
def test_leaks_against_brute_force(spark, shard):
    rnd = random.Random(8)
    items = [(k, text_of(rnd, rnd.randrange(20, 40))) for k in range(12)] + [(100, "a b"), (101, None), (102, "")]
    items.append((103, items[0][1]))
    # the same opening in many items, one of which is hardly more than that
    items += [(200 + k, f"please read the sign on the left side and say what it says {text_of(rnd, 5 + 4 * (k % 6))}") for k in range(30)]
    rows = [(1, None), (2, ""), (3, "w1 w2"), (None, items[0][1])]
    for d in range(4, 60):
        parts = [text_of(rnd, rnd.randrange(5, 40))]
        if d % 3:
            w = rnd.choice(items[:12])[1].split()
            a = rnd.randrange(len(w) // 2)
            parts.insert(rnd.randrange(2), " ".join(w[a : a + rnd.randrange(4, len(w))]).upper())
        rows.append((d, "\n".join(parts)))
    rows.append((900, rows[-1][1]))
    rows += [(1000 + k, f"{text_of(rnd, 9)} please read the sign on the left side and say what it says {text_of(rnd, 3)} a B, {items[20 + k][1]}") for k in range(6)]
    table = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    hits = leakage.leaks(docs(spark, rows), table, shard_words=shard)
    got = {(r.doc_id, r.item_id): r.held_words for r in hits.collect()}
    assert got == held_pairs(rows, items) and len(got) > 10
    blocks = leakage.leaks(docs(spark, rows), table, shard_words=shard, block_words=100).collect()
    assert {(r.doc_id, r.item_id): r.held_words for r in blocks} == got
    # the spans hold runs of the item and nothing else
    for r in hits.collect():
        w = re.findall(r"[^\W_]+", dict(rows)[r.doc_id].lower())
        q = re.findall(r"[^\W_]+", dict(items)[r.item_id].lower())
        n = min(4, len(q))
        runs = {tuple(q[i : i + n]) for i in range(len(q) - n + 1)}
        own = {i + j for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in runs for j in range(n)}
        assert own == {i for a, b in zip(r.first_words, r.last_words) for i in range(a, b + 1)}


def test_shared_phrases_bring_up_few_pairs(monkeypatch):
    """A hundred items begin alike; a document with that opening alone brings up none of them."""
    opening = "read the sign on the left side of the road".split()
    p = leakage.Phrases([(k, [*opening, *(f"own{k}x{j}" for j in range(12))]) for k in range(100)])
    brought = []
    monkeypatch.setattr(leakage, "_verified", lambda pairs, *_: brought.append(len(pairs)) or [])
    index = FMIndex([opening, [*opening, "own7x0", "own7x1", "own7x2", "own7x3"]])
    leakage._judge(*leakage._finds(index, p)[0:1], *leakage._finds(index, p)[1:], p)
    assert sum(brought) == 1


def test_spans_merge_over_items(spark):
    hits = spark.createDataFrame([(1, 1, 4, 4, [0, 20], [9, 29]), (1, 2, 4, 4, [5, 30, 50], [12, 33, 53]), (2, 1, 4, 4, [3], [6])], leakage.HITS)
    got = sorted(tuple(r) for r in leakage.removal_spans(hits).collect())
    assert got == [(1, 0, 12), (1, 20, 33), (1, 50, 53), (2, 3, 6)]


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leakage.leaks(docs(spark, [(1, "a b c d e")]), none).collect() == []
    assert leakage.leaks(docs(spark, []), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).collect() == []


# repetition


def repeated(words, run=5):
    seen, hit = set(), set()
    for i in range(len(words) - run + 1):
        g = tuple(words[i : i + run])
        if g in seen:
            hit.update(range(i, i + run))
        seen.add(g)
    return len(hit)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=6))
def test_repeated_words(texts):
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": [" ".join(t) for t in texts]})
    out = list(repetition.measured(iter([frame] if len(frame) else [])))
    got = pd.concat(out) if out else pd.DataFrame(columns=["doc_id"])
    assert len(got) == len(texts)
    for k, column in ((5, "repeated_words"), (3, "short_words")):
        assert [repeated(t, k) for t in texts] == (got[column].tolist() if len(got) else [])


def test_small_chunks_measure_the_same(spark):
    rnd = random.Random(1)
    frame = pd.DataFrame({"doc_id": range(50), "text": [text_of(rnd, rnd.randrange(80), 5) for _ in range(50)]})
    a, b = (pd.concat(list(repetition.measured(iter([frame]), n))).reset_index(drop=True) for n in (1 << 20, 30))
    pd.testing.assert_frame_equal(a, b)


def test_votes_recover_hidden_accuracies():
    rnd = np.random.default_rng(2)
    y = rnd.random(20_000) < 0.06
    hit, false = np.array([0.95, 0.8, 0.7, 0.5]), np.array([0.02, 0.05, 0.01, 0.1])
    votes = (rnd.random((len(y), 4)) < np.where(y[:, None], hit, false)).astype(int)
    votes[rnd.random(votes.shape) < 0.2] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = repetition.estimate(patterns, counts.astype(float))
    assert abs(found.repetitive - 0.06) < 0.01
    assert np.abs(found.hit - hit).max() < 0.06 and np.abs(found.false - false).max() < 0.02


def test_documents_above_the_limit(spark):
    rnd = random.Random(3)
    fresh = lambda n: " ".join(f"u{rnd.randrange(10**9)}" for _ in range(n))
    rows = [(i, fresh(60)) for i in range(200)]
    rows += [(1000 + i, ("buy this very good thing now. " * 8) + fresh(10)) for i in range(12)]
    rows += [(2000, None), (2001, ""), (2002, "one two"), (None, "x " * 50), (2003, "spam " * 40_000), (2004, fresh(70) + " a b c d e f " * 2)]
    out = repetition.repetitive(docs(spark, rows), "doc_id", "text")
    got = sorted(r.doc_id for r in repetition.above_limit(out).collect())
    want = sorted(i for i, t in rows if i is not None and t and repeated(t.replace(".", " ").lower().split()) > 0.3 * len(t.split()))
    assert got == want and len(got) == 13
    kept = {r.doc_id: r for r in out.collect()}
    assert len(kept) == 200 + 12 + 4 and kept[2001].repeated_share == 0 and kept[2004].repeated_words == 6


@pytest.mark.parametrize("sep", ["\n\n", " "])
def test_a_phrase_in_different_sentences_is_above_the_limit(spark, sep):
    rnd = random.Random(4)
    fresh = lambda n: " ".join(f"u{rnd.randrange(10**9)}" for _ in range(n))
    rows = [(i, sep.join(f"{fresh(8)}." for _ in range(5))) for i in range(2000)]
    rows += [(3000 + i, sep.join(["buy this very good thing now here today again."] * 8 + [fresh(4) + "."])) for i in range(100)]
    # few beside many: the other rules' votes outweigh that of the runs
    rows += [(4000 + i, sep.join(f"{fresh(11)} how one two three four five six {fresh(2)}." for _ in range(12))) for i in range(20)]
    out = repetition.repetitive(docs(spark, rows), "doc_id", "text")
    # votes for and against: what the posterior leaves out the check of the doubtful finds
    assert {r.doc_id for r in repetition.above_limit(out).collect()} == {i for i, _ in rows if i >= 3000}
    a = repetition.accuracy(out).first()
    assert a.above_limit == 120 == a.both + a.doubtful_above and a.both >= 100 and a.doubtful < 40


def test_no_rule_looks_at_the_measured_share():
    assert all("repeated" not in str(r.vote()) for r in repetition.rules())


def test_no_documents(spark):
    out = repetition.repetitive(docs(spark, []), "doc_id", "text")
    assert repetition.above_limit(out).collect() == []
    assert tuple(repetition.accuracy(out).first()) == (0,) * 6
