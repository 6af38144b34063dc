"""Problem 4: the consensus of several readers on each text node, and how reliable each reader is.

The possible texts of a node are those that its readers saw. A reader is right with a probability
for each band of its own confidence; where it errs, its confusion matrix says which characters it
takes for which, drops or adds. Expectation-maximisation alternates between the probability of each
text given all readings of the node, and these figures; counts are smoothed by those of all readers
together. Readers that make the same mistakes together count less where they agree, so one that
copies another is no second witness. Agreement corrected for chance is reported apart and uses
none of this.

Everything is estimated over all readings. The texts of a node are aligned once, each two of them, all
nodes of a batch together. The driver holds the matrices only, readers x characters squared; each pass
sums their counts in Spark. The characters are the most frequent ones of the readings, in any script, as
many as MATRIX_CELLS allows; rarer ones share a code.

Results for odd input: of several readings by one reader on one node the one with the latest
``read_at`` counts (null is oldest; ties: the greatest text); if that has no letter or digit the
reader has no vote there; nodes without a vote give no row; a null reader is a reader named "";
rows with a null image_id or node_id are out; confidences above 1 are per cent, null, NaN and
negative ones a band of their own; equal probabilities go to the smaller text; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import spaced_key
from glyphloom.llm import align
from glyphloom.session import written

#: Codes of characters: 0 none, then the alphabet's; OTHER any other, DIFFERENT another such.
NONE, OTHER, DIFFERENT, FIRST = 0, 1, 2, 3
#: Cells of all readers' confusion matrices together: they bound the alphabet, whose characters are
#: the most frequent ones of the readings in whatever script; rarer ones share the code OTHER.
MATRIX_CELLS = 1_000_000
MOST_CODES = 512
#: Upper ends of the bands of confidence; band 0 is for none.
BANDS = (0.55, 0.7, 0.85, 0.95)
MAX_READERS = 500
#: Rounds end when no reader's accuracy in any band changes by more than STILL, at the latest after ROUNDS.
ROUNDS = 30
STILL = 0.002
#: The chance of one more slip in a text that has one.
MORE = 0.3

NODES = "image_id string, node_id string, readers array<int>, bands array<int>, texts array<string>, voted array<int>, lengths array<int>, slips array<int>"


def votes(readings: DataFrame) -> DataFrame:
    """(image_id, node_id, reader, text, band): each reader's vote on each node, if it has one."""
    c = F.col("confidence")
    share = F.when(c > 1, c / 100).otherwise(c)
    band = F.when(c.isNull() | F.isnan(c) | (c < 0), 0)
    for i, end in enumerate(BANDS, start=1):
        band = band.when(share < end, i)
    band = band.otherwise(len(BANDS) + 1)
    kept = readings.where("image_id is not null and node_id is not null")
    named = kept.select("image_id", "node_id", F.coalesce("model_name", F.lit("")).alias("reader"), "read_at", F.coalesce(spaced_key(F.col("text")), F.lit("")).alias("text"), band.alias("band"))
    last = named.groupBy("image_id", "node_id", "reader").agg(F.max(F.struct("read_at", "text", "band")).alias("v"))
    return last.select("image_id", "node_id", "reader", "v.text", "v.band").where("text <> ''")


def alphabet_of(votes: DataFrame, readers: int) -> np.ndarray:
    """The code points that have a code of their own, by falling frequency in all votes."""
    most = min(MOST_CODES, math.isqrt(MATRIX_CELLS // max(readers, 1))) - FIRST
    texts = votes.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    chars = texts.select("n", F.explode(F.split("text", "")).alias("c")).where("c <> ''").groupBy("c").agg(F.sum("n").alias("n"))
    return np.array([ord(r["c"]) for r in chars.orderBy(F.desc("n"), "c").limit(most).collect()], dtype=np.int64)


class Coder:
    """Code points to codes."""

    def __init__(self, alphabet: np.ndarray):
        self.order = np.argsort(alphabet)
        self.points = alphabet[self.order]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """-1 stands for none."""
        at = np.minimum(np.searchsorted(self.points, points), max(len(self.points) - 1, 0))
        known = self.points[at] == points if len(self.points) else np.zeros(len(points), dtype=bool)
        code = self.order[at] + FIRST if len(self.points) else at
        return np.where(points < 0, NONE, np.where(known, code, OTHER))


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each length, one after the other."""
    return np.repeat(starts - _starts(lengths), lengths) + np.arange(int(lengths.sum()))


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind))


def _prepared(batches: Iterator[pa.RecordBatch], coder: Coder) -> Iterator[pa.RecordBatch]:
    """NODES: the distinct texts of every node in order, and where each two of them differ."""
    names = [c.split()[0] for c in NODES.split(", ")]
    for batch in batches:
        held = batch.column(2)
        n_votes = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = held.flatten()
        reader, band = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("reader", "band"))
        seen = pa.array(flat.field("text")).dictionary_encode()
        words = seen.dictionary.to_pylist()
        # numbers of texts in the order of their code points
        order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        text = rank[seen.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        node = np.repeat(np.arange(batch.num_rows), n_votes)
        by_reader = np.lexsort((text, band, reader, node))
        reader, band, text = reader[by_reader], band[by_reader], text[by_reader]
        each, voted = np.unique(node * max(len(words), 1) + text, return_inverse=True)
        text_node, text_rank = each // max(len(words), 1), each % max(len(words), 1)
        n_texts = np.bincount(text_node, minlength=batch.num_rows)
        first = _starts(n_texts)
        # pairs i < j of the texts of a node, node by node, i by i
        after = n_texts[text_node] - (np.arange(len(each)) - first[text_node]) - 1
        i, j = np.repeat(np.arange(len(each)), after), _runs(np.arange(len(each)) + 1, after)
        pairs, which = np.unique(text_rank[i] * max(len(words), 1) + text_rank[j], return_inverse=True)
        sorted_words = [words[k] for k in order.tolist()]
        pair, a, b = align.slips(align.Texts(sorted_words), pairs // max(len(words), 1), pairs % max(len(words), 1))
        x, y = coder.codes(a), coder.codes(b)
        y = np.where((x == OTHER) & (y == OTHER), DIFFERENT, y)
        n_slips = np.bincount(pair, minlength=len(pairs))
        lengths = n_slips[which]
        slips = (x * MOST_CODES + y)[_runs(_starts(n_slips)[which], lengths)]
        n_pairs = n_texts * (n_texts - 1) // 2
        per_node = np.bincount(text_node[i], weights=lengths, minlength=batch.num_rows).astype(np.int64)
        texts = pa.array(sorted_words, pa.string()).take(pa.array(text_rank)) if len(words) else pa.array([], pa.string())
        columns = [batch.column(0), batch.column(1), _lists(reader, n_votes, pa.int32()), _lists(band, n_votes, pa.int32()), _lists(texts, n_texts, pa.string()), _lists(voted - first[node], n_votes, pa.int32()), _lists(lengths, n_pairs, pa.int32()), _lists(slips, per_node, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names)


@dataclass
class Model:
    """What the readers do; index r: reader, k: band of confidence, a: true character, b: seen."""

    readers: list[str]
    right: np.ndarray  # [r, k] share of readings that are right
    slips: np.ndarray  # [r, a, b] of the reader's slips, the share that are b for a; 0 for none
    copies: np.ndarray  # [r, s] share of the mistakes of either that both make alike
    reliability: np.ndarray = field(default_factory=lambda: np.zeros(0))  # [r] share of right readings
    readings: np.ndarray = field(default_factory=lambda: np.zeros(0))  # [r]

    @staticmethod
    def start(readers: list[str], codes: int) -> Model:
        n = len(readers)
        return Model(readers, np.full((n, len(BANDS) + 2), 0.7), np.full((n, codes, codes), 1 / codes**2), np.zeros((n, n)))


class Batch:
    """Some nodes, flattened: votes, texts, pairs of a vote and another text, slips of the pairs."""

    def __init__(self, batch: pa.RecordBatch):
        self.nodes = batch.num_rows
        flat = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        length = lambda name: batch.column(name).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        n_votes, n_texts = length("readers"), length("texts")
        self.reader, self.band = flat("readers"), flat("bands")
        self.vote_node = np.repeat(np.arange(self.nodes), n_votes)
        self.text_node = np.repeat(np.arange(self.nodes), n_texts)
        first = _starts(n_texts)
        own = flat("voted")  # number of the voted text in its node
        self.vote_text = own + first[self.vote_node]
        self.texts = len(self.text_node)
        pairs = n_texts[self.vote_node]
        self.pair_vote = np.repeat(np.arange(len(self.reader)), pairs)
        self.pair_text = _runs(first[self.vote_node], pairs)
        self.same = self.vote_text[self.pair_vote] == self.pair_text
        # of texts i < j of a node with n texts, the pair is number i * (2 n - i - 1) / 2 + j - i - 1 of the node
        lengths, slips = flat("lengths"), flat("slips")
        wrong = np.flatnonzero(~self.same)
        node = self.vote_node[self.pair_vote[wrong]]
        seen, true = own[self.pair_vote[wrong]], self.pair_text[wrong] - first[node]
        i, j, n = np.minimum(seen, true), np.maximum(seen, true), n_texts[node]
        number = _starts(n_texts * (n_texts - 1) // 2)[node] + i * (2 * n - i - 1) // 2 + j - i - 1
        self.slips = np.zeros(len(self.same), dtype=np.int64)
        self.slips[wrong] = lengths[number]
        self.pair = np.repeat(wrong, lengths[number])
        code = slips[_runs(_starts(lengths)[number], lengths[number])]
        a, b = code // MOST_CODES, code % MOST_CODES
        turned = np.repeat(true > seen, lengths[number])
        b, a = np.where(turned, a, b), np.where(turned, b, a)
        # the first of two different characters without a code is OTHER, whichever is the true one
        swap = turned & (a == DIFFERENT)
        self.a, self.b = np.where(swap, b, a), np.where(swap, a, b)

    def members(self, readers: int) -> np.ndarray:
        """[text, reader]: 1 where the reader saw the text."""
        m = np.zeros((self.texts, readers))
        m[self.vote_text, self.reader] = 1
        return m

    def shares(self) -> np.ndarray:
        """The start: texts by the squared number of their votes."""
        n = np.bincount(self.vote_text, minlength=self.texts).astype(float) ** 2
        return n / np.bincount(self.text_node, weights=n, minlength=self.nodes)[self.text_node]

    def posterior(self, m: Model) -> np.ndarray:
        """The probability of every text of a node."""
        vote = self.pair_vote[self.pair]
        slip = np.log(m.slips[self.reader[vote], self.a, self.b])
        each = np.bincount(self.pair, weights=slip, minlength=len(self.pair_vote))
        right = m.right[self.reader, self.band][self.pair_vote]
        wrong = np.log1p(-right) + each + np.log1p(-MORE) + np.log(MORE) * (self.slips - 1)
        pair = np.where(self.same, np.log(right), wrong)
        alike = (self.members(len(m.readers)) @ m.copies.T)[self.vote_text, self.reader]
        score = np.bincount(self.pair_text, weights=pair / (1 + alike)[self.pair_vote], minlength=self.texts)
        top = np.full(self.nodes, -np.inf)
        np.maximum.at(top, self.text_node, score)
        p = np.exp(score - top[self.text_node])
        return p / np.bincount(self.text_node, weights=p, minlength=self.nodes)[self.text_node]

    def counts(self, m: Model, q: np.ndarray) -> np.ndarray:
        """Expected counts for the next model, in the order of _sections."""
        n, bands = m.right.shape
        codes = m.slips.shape[1]
        of = lambda keys, weights, size: np.bincount(keys, weights=weights, minlength=size)
        r, w = self.reader[self.pair_vote[self.pair]], q[self.pair_text[self.pair]]
        slips = of((r * codes + self.a) * codes + self.b, w, n * codes * codes)
        band = self.reader * bands + self.band
        members = self.members(n)
        present = np.zeros((self.nodes, n))
        present[self.vote_node, self.reader] = 1
        right = members.T @ (members * q[:, None])
        parts = [slips, of(band, q[self.vote_text], n * bands), of(band, None, n * bands), (members.T @ members - right).ravel(), (present.T @ present - right).ravel()]
        return np.concatenate(parts)


def _sections(m: Model) -> list[int]:
    n, bands = m.right.shape
    return [m.slips.size, n * bands, n * bands, n * n, n * n]


def fitted(m: Model, counts: np.ndarray) -> Model:
    n = len(m.readers)
    slips, right, readings, same, either = np.split(counts, np.cumsum(_sections(m))[:-1])
    slips, right, readings = slips.reshape(m.slips.shape), right.reshape(m.right.shape), readings.reshape(m.right.shape)
    # slips of all readers, of the reader; readings of the reader, of the reader with that confidence
    every = slips.sum(axis=0) + 0.01
    every /= every.sum()
    own = slips + 20 * every
    own /= own.sum(axis=(1, 2), keepdims=True)
    share = (right.sum(axis=1) + 1) / (readings.sum(axis=1) + 2)
    band = (right + 10 * share[:, None]) / (readings + 10)
    copies = same.reshape(n, n) / (either.reshape(n, n) + 20)
    np.fill_diagonal(copies, 0)
    total = readings.sum(axis=1)
    return Model(m.readers, np.clip(band, 0.01, 0.995), own, np.clip(copies, 0, 1), right.sum(axis=1) / np.maximum(total, 1), total)


@dataclass(frozen=True)
class Consensus:
    nodes: DataFrame  # NODES, a written table
    model: Model

    def found(self) -> DataFrame:
        """(image_id, node_id, text_normalized, probability, readers, agreeing): every node's text;
        agreeing is the share of its pairs of votes that are equal, null for a single vote."""
        sent = self.nodes.sparkSession.sparkContext.broadcast(self.model)

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for f in _slices(batches, len(sent.value.readers)):
                b = Batch(f)
                q = b.posterior(sent.value).round(12)
                order = np.lexsort((np.arange(len(q)), -q, b.text_node))  # texts of a node are sorted
                first = order[np.concatenate([[True], np.diff(b.text_node[order]) > 0])]
                n = np.bincount(b.vote_node, minlength=b.nodes)
                same = np.bincount(b.vote_text, minlength=b.texts)
                pairs = np.bincount(b.text_node, weights=same * (same - 1), minlength=b.nodes)
                agree = pa.array(pairs / np.maximum(n * (n - 1), 1), mask=n < 2)
                texts = f.column("texts").flatten().take(pa.array(first))
                yield pa.RecordBatch.from_arrays([f.column("image_id"), f.column("node_id"), texts, pa.array(q[first]), pa.array(n, pa.int32()), agree], ["image_id", "node_id", "text_normalized", "probability", "readers", "agreeing"])

        return self.nodes.mapInArrow(best, "image_id string, node_id string, text_normalized string, probability double, readers int, agreeing double")

    def reliability(self) -> DataFrame:
        """(reader, readings, reliability, most_alike, copied_share): a row a reader; most_alike is
        the reader with whom it shares the largest part of the mistakes of either."""
        m, rows = self.model, []
        for i, name in enumerate(m.readers):
            s = int(m.copies[i].argmax())
            rows.append((name, int(m.readings[i]), float(m.reliability[i]), m.readers[s] if s != i else None, float(m.copies[i, s])))
        return self.nodes.sparkSession.createDataFrame(rows, "reader string, readings long, reliability double, most_alike string, copied_share double")


def _slices(batches: Iterator[pa.RecordBatch], readers: int) -> Iterator[pa.RecordBatch]:
    """Batches of so few nodes that a table of their texts by readers stays small."""
    step = max(20, 500_000 // max(readers, 1) ** 2)
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def consensus(readings: DataFrame, rounds: int = ROUNDS, still: float = STILL) -> Consensus:
    spark = readings.sparkSession
    cast = written(votes(readings), "votes")
    readers = [r["reader"] for r in cast.select("reader").distinct().orderBy("reader").limit(MAX_READERS + 1).collect()]
    if len(readers) > MAX_READERS:
        raise ValueError(f"more than {MAX_READERS} readers")
    alphabet = alphabet_of(cast, len(readers))
    coder = Coder(alphabet)
    # a node has at most one vote of each reader
    numbered = cast.withColumn("reader", F.array_position(F.array(*map(F.lit, readers)), F.col("reader")).cast("int") - 1) if readers else cast.withColumn("reader", F.lit(0))
    grouped = numbered.groupBy("image_id", "node_id").agg(F.collect_list(F.struct("reader", "text", "band")).alias("votes"))
    n = len(readers)
    nodes = written(grouped.mapInArrow(lambda batches: _prepared(_slices(batches, n), coder), NODES), "nodes")
    model = Model.start(readers, len(alphabet) + FIRST)
    for i in range(rounds if readers else 0):
        sent = spark.sparkContext.broadcast(model)  # at most MATRIX_CELLS and readers squared numbers

        def counted(batches: Iterator[pa.RecordBatch], first: bool = i == 0, sent=sent) -> Iterator[pa.RecordBatch]:
            total = None
            for f in _slices(batches, n):
                b = Batch(f)
                c = b.counts(sent.value, b.shares() if first else b.posterior(sent.value))
                total = c if total is None else total + c
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

        sums = nodes.mapInArrow(counted, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(sum(_sections(model)))
        for r in sums:
            counts[r["at"]] = r["n"]
        old, model = model, fitted(model, counts)
        sent.unpersist()
        if i and np.abs(model.right - old.right).max() <= still:
            break
    return Consensus(nodes, model)


def chance_corrected(readings: DataFrame) -> DataFrame:
    """(readings, observed, by_chance, alpha): one row; Krippendorff's nominal alpha over the nodes
    with two votes or more. observed and by_chance are shares of equal pairs."""
    cast = votes(readings)
    texts = cast.groupBy("image_id", "node_id", "text").agg(F.count(F.lit(1)).alias("n"))
    node = texts.groupBy("image_id", "node_id").agg(F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same")).where("m > 1")
    observed = node.agg(F.sum("m").alias("readings"), (F.sum(F.col("same") / (F.col("m") - 1)) / F.sum("m")).alias("observed"))
    kept = texts.join(node.select("image_id", "node_id"), ["image_id", "node_id"], "left_semi").groupBy("text").agg(F.sum("n").alias("n"))
    chance = kept.agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1)).alias("pairs"))
    n = F.col("readings").cast("double")
    both = observed.join(F.broadcast(chance))  # one row each
    by_chance = F.col("pairs") / (n * (n - 1))
    return both.select("readings", "observed", by_chance.alias("by_chance"), ((F.col("observed") - by_chance) / (1 - by_chance)).alias("alpha"))
