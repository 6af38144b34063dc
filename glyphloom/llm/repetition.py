"""Problem 9: repetition inside a document, judged by rules whose accuracies are estimated.

For each document the shares of words in repeated runs, lines, sentences and paragraphs, the size of
its vocabulary and how far it compresses are measured over its whole text. Each rule votes that the
document is repetitive, that it isn't, or abstains; none of them looks at the share that the limit is
about. Expectation-maximisation over the counts of the vote patterns (at most 3 to the number of
rules, however many documents) estimates each rule's accuracies and the share of repetitive documents
without labels; every document gets the posterior probability of its votes, and those of at least
LIKELY are chosen. An exact check of the repeated share follows.

A document that isn't chosen but that the check would find is not lost: a repeated run of five words
is made of repeated runs of three, so only one whose share of these exceeds the limit can be above it.
Such doubtful documents are checked too; ``accuracy`` reports how many they were and how the
posterior alone did.

Results for odd input: null texts are left out, as are rows with a null id; a text with fewer than
RUN words has the share 0; repeated texts under other ids are measured each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import PY_WORD
from glyphloom.session import ship, written

RUN = 5
LIMIT = 0.3
#: A document with at least this posterior probability of being repetitive is chosen.
LIKELY = 0.5
#: Words measured at once: bounds a task's memory; a longer text is measured alone.
CHUNK_WORDS = 1 << 20
MEASURES = "doc_id long, words long, repeated_words long, short_words long, distinct_words long, packed_share double, line_share double, sentence_share double, paragraph_share double, lines long, sentences long, paragraphs long"


def _groups(ids: np.ndarray, doc: np.ndarray, starts: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of starts whose run of words also starts at another one of the same document, and for
    each the first such place."""
    key = doc[starts].astype(np.uint64)
    for j in range(run):
        key = (key ^ ids[starts + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key)
    at, key = starts[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    size = np.diff(np.append(np.flatnonzero(new), len(key)))
    several = np.repeat(size > 1, size)
    at, size = at[several], size[size > 1]
    if not len(at):
        return at, at
    first = np.repeat(np.minimum.reduceat(at, np.cumsum(size) - size), size)
    # equal keys must be equal runs of one document
    if not all((ids[at + j] == ids[first + j]).all() for j in range(run)) or (doc[at] != doc[first]).any():
        rows = np.column_stack([doc[starts], *(ids[starts + j] for j in range(run))])
        _, where, group, size = np.unique(rows, axis=0, return_index=True, return_inverse=True, return_counts=True)
        several = size[group.ravel()] > 1
        at, first = starts[several], starts[where[group.ravel()]][several]
    return at, first


def repeated_words(ids: np.ndarray, doc: np.ndarray, runs: tuple[int, ...], docs: int) -> list[np.ndarray]:
    """For each length of runs, which must rise: how many words of each of docs documents lie in a
    run that starts at an earlier place of the same document too.

    ids, doc: number and document of each word, the documents in order from 0."""
    out, starts = [], np.arange(len(ids))
    for run in runs:
        starts = starts[starts + run <= len(ids)]
        starts = starts[doc[starts] == doc[starts + run - 1]]
        if not len(starts):
            out.append(np.zeros(docs, dtype=np.int64))
            continue
        at, first = _groups(ids, doc, starts, run)
        again = at[at != first]
        edge = np.zeros(len(ids) + 1, dtype=np.int32)
        edge[again] += 1
        edge[again + run] -= 1
        out.append(np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs))
        starts = np.sort(at)  # a longer run can only be repeated where this one is
    return out


def _share(parts: list[str]) -> tuple[float, int]:
    """The share of characters in parts that stood before, and the number of parts."""
    seen: set[str] = set()
    total = again = n = 0
    for p in parts:
        if p := p.strip():
            n += 1
            total += len(p)
            if p in seen:
                again += len(p)
            else:
                seen.add(p)
    return (again / total if total else 0.0), n


def measured(frames: Iterator[pd.DataFrame], chunk_words: int = CHUNK_WORDS) -> Iterator[pd.DataFrame]:
    """MEASURES of (doc_id, text) frames."""
    find, stop = re.compile(PY_WORD).findall, re.compile(r"[.!?\n]+").split
    held: list[tuple] = []
    tokens: list[list[str]] = []
    size = 0

    def flush() -> pd.DataFrame:
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(tokens)), dtype=np.int64, count=size)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        doc = np.repeat(np.arange(len(tokens)), lengths)
        short, run = repeated_words(ids, doc, (RUN - 2, RUN), len(tokens))
        rest = list(zip(*(h[1:] for h in held)))
        names = [c.split()[0] for c in MEASURES.split(", ")]
        out = pd.DataFrame(dict(zip(names, [[h[0] for h in held], lengths, run, short, *rest])))
        held.clear()
        tokens.clear()
        return out

    for frame in frames:
        for doc_id, text in zip(frame["doc_id"].tolist(), frame["text"].tolist()):
            low = text.lower()
            ws = find(low)
            (line, n_line), (sent, n_sent), (para, n_para) = _share(low.split("\n")), _share(stop(low)), _share(low.split("\n\n"))
            raw = low.encode("utf-8", "surrogatepass")
            held.append((doc_id, len(set(ws)), len(zlib.compress(raw, 1)) / max(len(raw), 1), line, sent, para, n_line, n_sent, n_para))
            tokens.append(ws)
            size += len(ws)
            if size >= chunk_words:
                yield flush()
                size = 0
    if held:
        yield flush()


def measures(df: DataFrame, key: str, text: str, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """MEASURES and repeated_share of every document with a text."""
    ship(df.sparkSession)
    docs = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = docs.mapInPandas(lambda frames: measured(frames, chunk_words), MEASURES)
    return found.withColumn("repeated_share", _of("repeated_words"))


def _of(n: str) -> Column:
    return F.when(F.col("words") > 0, F.col(n) / F.col("words")).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Rule:
    """Votes 1 above ``high``, 0 below ``low``, else abstains; also where ``applies`` is false."""

    name: str
    value: Column
    low: float
    high: float
    applies: Column

    def vote(self) -> Column:
        v = F.when(~self.applies, F.lit(None)).when(self.value > self.high, 1).when(self.value <= self.low, 0)
        return v.cast("int").alias(f"vote_{self.name}")


def rules() -> list[Rule]:
    return [
        Rule("phrases", _of("short_words"), 0.2, 0.35, F.col("words") >= RUN),
        Rule("vocabulary", 1 - _of("distinct_words"), 0.45, 0.7, F.col("words") >= 4 * RUN),
        Rule("packing", 1 - F.col("packed_share"), 0.52, 0.64, F.col("words") >= 4 * RUN),
        Rule("lines", F.col("line_share"), 0.05, 0.2, F.col("lines") >= 4),
        Rule("sentences", F.col("sentence_share"), 0.05, 0.2, F.col("sentences") >= 4),
        Rule("paragraphs", F.col("paragraph_share"), 0.05, 0.2, F.col("paragraphs") >= 3),
    ]


@dataclass(frozen=True)
class Accuracies:
    repetitive: float  # share of repetitive documents
    hit: np.ndarray  # of each rule, the share of votes 1 on repetitive documents
    false: np.ndarray  # and on others

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """votes: a row a pattern; 1, 0, or -1 for an abstention."""
        yes, no = votes == 1, votes == 0
        a = np.log(self.repetitive) + (yes * np.log(self.hit) + no * np.log1p(-self.hit)).sum(axis=1)
        b = np.log1p(-self.repetitive) + (yes * np.log(self.false) + no * np.log1p(-self.false)).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(b - a, -700, 700)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 2.0) -> Accuracies:
    """Expectation-maximisation from the share of votes that say repetitive; smoothing counts keep
    a rule's accuracies on its side of even odds where there are few votes."""
    voted = votes >= 0
    p = np.where(voted.any(axis=1), (votes == 1).sum(axis=1) / np.maximum(voted.sum(axis=1), 1), 0.1)
    for _ in range(rounds if len(counts) else 1):
        w = counts * p
        share = (w.sum() + 1) / (counts.sum() + 2)
        rate = lambda w, up, down: ((w[:, None] * (votes == 1)).sum(axis=0) + up) / ((w[:, None] * voted).sum(axis=0) + up + down)
        found = Accuracies(share, rate(w, 2 * smooth, smooth), rate(counts - w, smooth, 2 * smooth))
        q = found.posterior(votes)
        done, p = np.abs(q - p).max(initial=0.0) < 1e-9, q
        if done:
            break
    return found


def judged(measures: DataFrame) -> tuple[DataFrame, list[tuple]]:
    """The documents with each rule's vote and the posterior probability of being repetitive; and
    (rule, hit rate, false rate) as estimated. measures must be a written table."""
    rs = rules()
    names = [f"vote_{r.name}" for r in rs]
    voted = measures.select("*", *(r.vote() for r in rs))
    pattern = [F.coalesce(n, F.lit(-1)).alias(n) for n in names]
    # at most 3 ** len(rs) rows
    counts = voted.select(*pattern).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect()
    votes = np.array([[r[n] for n in names] for r in counts], dtype=np.int64).reshape(-1, len(names))
    found = estimate(votes, np.array([r["n"] for r in counts], dtype=float))
    posterior = [(*map(int, v), float(p)) for v, p in zip(votes, found.posterior(votes))]
    table = measures.sparkSession.createDataFrame(posterior, ", ".join(f"_{n} int" for n in names) + ", posterior double")
    same = [F.coalesce(voted[n], F.lit(-1)) == table[f"_{n}"] for n in names]
    out = voted.join(F.broadcast(table), same).drop(*(f"_{n}" for n in names))
    return out, [(n, float(a), float(b)) for n, a, b in zip(names, found.hit, found.false)]


def repetitive(df: DataFrame, key: str, text: str) -> DataFrame:
    """All documents with their measures, votes and posterior."""
    return judged(written(measures(df, key, text), "measures"))[0]


def chosen(documents: DataFrame, likely: float = LIKELY) -> DataFrame:
    """The documents that are repetitive by the posterior of their votes."""
    return documents.where(F.col("posterior") >= likely)


def _above(limit: float) -> Column:
    return F.col("repeated_words") > F.col("words") * F.lit(limit)


def above_limit(documents: DataFrame, limit: float = LIMIT, likely: float = LIKELY) -> DataFrame:
    """The chosen documents that an exact check of the repeated share confirms, and what it finds among
    the doubtful rest, whose repeated runs of RUN - 2 words leave it possible."""
    doubtful = (F.col("posterior") < likely) & (F.col("short_words") > F.col("words") * F.lit(limit))
    return chosen(documents, likely).unionByName(documents.where(doubtful)).where(_above(limit))


def accuracy(documents: DataFrame, limit: float = LIMIT, likely: float = LIKELY) -> DataFrame:
    """(documents, above_limit, chosen, both, doubtful, doubtful_above): one row; how the posterior alone
    did against the exact share, and what it left to the check of the doubtful."""
    n = lambda c: F.count(F.when(c, 1))
    pick, above = F.col("posterior") >= likely, _above(limit)
    doubtful = ~pick & (F.col("short_words") > F.col("words") * F.lit(limit))
    return documents.agg(F.count(F.lit(1)).alias("documents"), n(above).alias("above_limit"), n(pick).alias("chosen"), n(pick & above).alias("both"), n(doubtful).alias("doubtful"), n(doubtful & above).alias("doubtful_above"))
