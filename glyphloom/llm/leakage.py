"""Problem 8: evaluation texts that leak into training texts, wholly or in part.

Every task builds FM-indexes over shards of its texts, of a bounded number of words, each once, and
searches all phrases of RUN consecutive words of the evaluation items in it, block of items after
block. The index knows nothing of the items. Each distinct phrase of a block is searched once, however
many items hold it. Occurrences are located; which items they may belong to is asked of an item's
rarest phrases only, so many that the others together hold too few of its words: a phrase that many
items share brings up none of them by itself. For the pairs so found the words of the item that lie in
an occurring phrase count as held. Nothing is shuffled. A text longer than a shard is indexed in
pieces that overlap by RUN - 1 words, so no phrase is lost, and its pieces' finds are put together
before they are judged.

Results for odd input: null texts and texts without a word hold nothing; an item of fewer than RUN words
is one phrase and held where all its words stand in order; items without a word leak nothing; rows with
a null id are left out; equal items are reported each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import PY_WORD, words
from glyphloom.llm.fmindex import FMIndex
from glyphloom.llm.shared import keep, read_rows
from glyphloom.session import fresh_path, ship

RUN = 4
#: Words of a shard: bounds a task's memory, whatever the size of its partition.
SHARD_WORDS = 1 << 20
#: Words of the evaluation items searched at once; more items are taken in blocks.
BLOCK_WORDS = 500_000
#: Pairs of a document and an item that are brought up at once.
PAIRS = 1 << 20
HITS = "doc_id long, item_id long, held_words long, item_words long, first_words array<long>, last_words array<long>"


#: The block that a Python worker holds, by its path.
_held: dict[str, Phrases] = {}


class Phrases:
    """A block of items: their distinct phrases, each item's own, and the rare ones that bring it up.

    Items with the same words are one here, ``ids`` has the ids of each."""

    def __init__(self, items: list[tuple[int, list[str]]], run: int = RUN, least: float = 0.5):
        self.run, self.least = run, least
        same: dict[tuple[str, ...], list[int]] = {}
        for i, ws in items:
            same.setdefault(tuple(ws), []).append(i)
        texts, self.ids = list(same), list(same.values())
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        number: dict[str, int] = {}
        flat = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), dtype=np.int64, count=int(self.sizes.sum()))
        self.vocabulary = list(number)
        # a row for every place where a phrase starts; -1 fills the phrases of items shorter than run
        self.places = np.maximum(self.sizes - run + 1, 1)
        self.item = np.repeat(np.arange(len(texts)), self.places)
        begin = np.cumsum(self.places) - self.places
        self.start = np.arange(int(self.places.sum())) - begin[self.item]
        at = (np.cumsum(self.sizes) - self.sizes)[self.item] + self.start
        inside = np.arange(run) < np.minimum(self.sizes, run)[self.item][:, None]
        rows = np.where(inside, flat[np.minimum(at[:, None] + np.arange(run), max(len(flat) - 1, 0))] if len(flat) else -1, -1)
        self.rows, self.phrase = np.unique(rows, axis=0, return_inverse=True)
        self.phrase = self.phrase.ravel()
        self.first = begin
        # places by phrase, of the rare ones of each item
        items_of = np.bincount(np.unique(self.phrase * max(len(texts), 1) + self.item) // max(len(texts), 1), minlength=len(self.rows))
        rare = self._rare(items_of)
        order = np.flatnonzero(rare)[np.argsort(self.phrase[rare], kind="stable")]
        self.rare_item = self.item[order]
        self.rare_first = np.searchsorted(self.phrase[order], np.arange(len(self.rows) + 1))

    def _rare(self, items_of: np.ndarray) -> np.ndarray:
        """The places whose phrase brings up its item: the rarest first, until the others cover fewer words
        than must be held."""
        rare = np.zeros(len(self.item), dtype=bool)
        for k, (a, n, size) in enumerate(zip(self.first.tolist(), self.places.tolist(), self.sizes.tolist())):
            often = items_of[self.phrase[a : a + n]]
            if (often <= 1).all():
                rare[a : a + n] = True
                continue
            covered = np.zeros(size, dtype=bool)
            wide, common = min(self.run, size), []
            for level in np.unique(often)[::-1]:
                mine = np.flatnonzero(often == level)
                for s in mine.tolist():
                    covered[s : s + wide] = True
                if covered.sum() >= self.least * size:
                    break
                common.append(mine)
            rare[a : a + n] = True
            if common:
                rare[a + np.concatenate(common)] = False
        return rare


def _merge(starts: np.ndarray, run: int) -> tuple[list[int], list[int]]:
    """Runs of ``run`` words at starts, as few spans of first and last words as cover them."""
    s = np.unique(starts)
    new = np.flatnonzero(np.concatenate([[True], s[1:] > s[:-1] + run]))
    ends = np.append(new[1:], len(s)) - 1
    return s[new].tolist(), (s[ends] + run - 1).tolist()


def _finds(index: FMIndex, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, phrase, word of the text) of every occurrence of a phrase."""
    numbers = np.array([*index.numbers(p.vocabulary), -1], dtype=np.int64)
    width = (p.rows >= 0).sum(axis=1)
    found = []
    for n in np.unique(width[width > 0]).tolist():  # items shorter than run have shorter phrases
        mine = np.flatnonzero(width == n)
        phrase, text, at = index.occurrences(numbers[p.rows[mine, :n]])
        found.append((text, mine[phrase], at))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3  # type: ignore[return-value]


def _judge(doc: np.ndarray, phrase: np.ndarray, at: np.ndarray, p: Phrases, pairs_at_once: int = PAIRS) -> list[tuple]:
    """(doc, item id, held words, words, first words, last words) of the pairs of which enough is held;
    doc numbers index nothing here. Holds the places of ``pairs_at_once`` pairs at a time."""
    order = np.lexsort((at, phrase, doc))
    doc, phrase, at = doc[order], phrase[order], at[order]
    if not len(doc):
        return []
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (phrase[1:] != phrase[:-1])])
    once_doc, once_phrase = doc[new], phrase[new]
    n = p.rare_first[once_phrase + 1] - p.rare_first[once_phrase]
    ends, out = np.cumsum(n), []
    items, phrases = max(len(p.ids), 1), max(len(p.rows), 1)
    held_keys = once_doc * phrases + once_phrase  # sorted
    lo = 0
    done = np.zeros(0, dtype=np.int64)
    while lo < len(n):
        # whole documents, so that a pair comes up once
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + pairs_at_once, "right")), lo + 1)
        hi = int(np.searchsorted(once_doc, once_doc[hi - 1], "right"))
        part = slice(lo, hi)
        k = n[part]
        place = np.repeat(p.rare_first[once_phrase[part]], k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        pairs = np.unique(np.repeat(once_doc[part], k) * items + p.rare_item[place])
        lo = hi
        for c in range(0, len(pairs), max(1, pairs_at_once // 64)):
            out += _verified(pairs[c : c + max(1, pairs_at_once // 64)], held_keys, items, phrases, doc, phrase, at, p)
    return out


def _verified(pairs: np.ndarray, held_keys: np.ndarray, items: int, phrases: int, doc: np.ndarray, phrase: np.ndarray, at: np.ndarray, p: Phrases) -> list[tuple]:
    item, d = pairs % items, pairs // items
    k = p.places[item]
    pair = np.repeat(np.arange(len(pairs)), k)
    place = np.repeat(p.first[item], k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
    key = d[pair] * phrases + p.phrase[place]
    i = np.minimum(np.searchsorted(held_keys, key), len(held_keys) - 1)
    hit = held_keys[i] == key
    pair, place = pair[hit], place[hit]
    wide = np.minimum(p.sizes[item], p.run)
    size = p.sizes[item]
    base = np.cumsum(size) - size
    words_of = int(size.sum())
    edge = np.bincount(base[pair] + p.start[place], minlength=words_of + 1) - np.bincount(base[pair] + p.start[place] + wide[pair], minlength=words_of + 1)
    held = np.add.reduceat((np.cumsum(edge)[:words_of] > 0).astype(np.int64), base) if len(pairs) else np.zeros(0, np.int64)
    out = []
    full_key = doc * phrases + phrase  # sorted
    by_pair = np.searchsorted(pair, np.arange(len(pairs) + 1))
    for q in np.flatnonzero((held > 0) & (held >= p.least * size)).tolist():
        mine = np.unique(p.phrase[place[by_pair[q] : by_pair[q + 1]]]) + d[q] * phrases
        a, b = np.searchsorted(full_key, mine, "left"), np.searchsorted(full_key, mine, "right")
        starts = at[np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange(int((b - a).sum()))]
        first, last = _merge(starts, int(wide[q]))
        out += [(int(d[q]), i, int(held[q]), int(size[q]), first, last) for i in p.ids[item[q]]]
    return out


def search_shards(frames: Iterator[pd.DataFrame], blocks: Callable[[], Iterator[Phrases]], run: int = RUN, shard_words: int = SHARD_WORDS) -> Iterator[pd.DataFrame]:
    """HITS of (doc_id, text) frames; blocks gives all blocks of items, and is called for each shard."""
    find = re.compile(PY_WORD).findall
    pieces: list[tuple[int, int, bool, list[str]]] = []  # doc_id, offset, last piece of a cut text, words
    size = 0
    cut: list[list[np.ndarray]] = []  # block, phrase and place of what was found in the text that is being read in pieces

    def flush() -> pd.DataFrame:
        nonlocal size
        index = FMIndex([w for *_, w in pieces])
        whole = np.array([offset == 0 and last for _, offset, last, _ in pieces], dtype=bool)
        parts, rows = np.flatnonzero(~whole).tolist(), []
        ends = [pieces[t][0] for t in parts if pieces[t][2]]  # a text that ends in this shard; there is one at most
        for b, p in enumerate(blocks()):
            text, phrase, at = _finds(index, p)
            mine = whole[text]
            rows += [(pieces[t][0], *rest) for t, *rest in _judge(text[mine], phrase[mine], at[mine], p)]
            for t in parts:
                doc_id, offset, last, _ = pieces[t]
                own = text == t
                cut.append([np.full(int(own.sum()), b), phrase[own], at[own] + offset])
                if last:
                    block, ph, a = (np.concatenate(x) for x in zip(*cut))
                    now = block == b
                    rows += [(doc_id, *rest) for _, *rest in _judge(np.zeros_like(ph[now]), ph[now], a[now], p)]
        if ends:
            cut.clear()
        pieces.clear()
        size = 0
        return pd.DataFrame(rows, columns=["doc_id", "item_id", "held_words", "item_words", "first_words", "last_words"])

    for frame in frames:
        for doc_id, text in zip(frame["doc_id"].tolist(), frame["text"].tolist()):
            ws = find(text.lower())
            if not ws:
                continue
            if len(ws) > shard_words and pieces:
                yield flush()  # so a text in pieces starts a shard of its own
            offset = 0
            while True:
                last = len(ws) - offset <= shard_words
                pieces.append((doc_id, offset, last, ws if last and not offset else ws[offset : offset + shard_words]))
                size += len(pieces[-1][3])
                if size >= shard_words or (last and offset):
                    yield flush()
                if last:
                    break
                offset += max(shard_words - run + 1, 1)
    if pieces:
        yield flush()


def _blocks(items: DataFrame, block_words: int) -> tuple[str, int]:
    """The items as files in the shared folder, of about block_words words each; their path and number."""
    total = items.agg(F.coalesce(F.sum(F.size("w")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(total / block_words))
    path = fresh_path(items.sparkSession, "items")
    block = F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int").alias("block")
    keep(items.select("item_id", "w", block).repartition(n, "block"), path, "block")
    return path, n


def leaks(docs: DataFrame, items: DataFrame, least: float = 0.5, run: int = RUN, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """HITS: the pairs of docs (doc_id, text) and items (item_id, text) of which the document holds
    at least the share ``least`` of the item's words, with the spans of the document to remove.

    The items lie in the shared folder in blocks of about block_words words; a task holds one block."""
    spark = docs.sparkSession
    ship(spark)
    split = items.where("item_id is not null").select(F.col("item_id").cast("long"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    path, n = _blocks(split, block_words)
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def blocks() -> Iterator[Phrases]:
        for b in range(n):
            name = f"{path}/block={b}"
            if name not in _held:
                _held.clear()
                _held[name] = Phrases(sorted(read_rows(name, ["item_id", "w"])), run, least)
            yield _held[name]

    return texts.mapInPandas(lambda frames: search_shards(frames, blocks, run, shard_words), HITS)


def removal_spans(hits: DataFrame) -> DataFrame:
    """(doc_id, first_word, last_word): what to remove from each document, in spans that neither
    overlap nor touch, whatever items they come from."""
    from pyspark.sql import Window

    spans = hits.select("doc_id", F.explode(F.arrays_zip("first_words", "last_words")).alias("s")).select("doc_id", F.col("s.first_words").alias("a"), F.col("s.last_words").alias("b")).distinct()
    w = Window.partitionBy("doc_id").orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("new", F.when(reach.isNull() | (F.col("a") > reach + 1), 1).otherwise(0))
    numbered = begun.withColumn("span", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "span").agg(F.min("a").alias("first_word"), F.max("b").alias("last_word")).drop("span")


def leaked_items(hits: DataFrame) -> DataFrame:
    """(item_id, documents, most_held): the items that leaked, with the number of documents."""
    return hits.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max(F.col("held_words") / F.col("item_words")).alias("most_held"))
