"""The queries of the training-data problems: name to (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphloom.llm import consensus, copies, leakage, mixture, packing, repetition, splits, terms, topn
from glyphloom.session import spread, table, written


def _p1(spark: SparkSession, d: str) -> DataFrame:
    answers = terms.records_of(table(spark, d, "ocr_qa_dataset"), "answer", "sample_id", "answer", "ingested_at")
    labels = terms.records_of(table(spark, d, "bootstrap_tuples"), "anchor_label", "ann_id", "anchor_label", "produced_at", terms.whole_label)
    return terms.marked(terms.term_frequencies(answers.unionByName(labels)))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _p1(spark, d).where("mark is not null").select("field_name", "term", "mark")


def p1_terms(spark: SparkSession, d: str) -> DataFrame:
    return _p1(spark, d).select("field_name", "term", "occurrences", "records", "mark")


#: (table, key, field of mix_targets, stratum) of the two mixtures.
MIXTURES = (("ocr_qa_dataset", "sample_id", "question_type", "answer_level"), ("bootstrap_tuples", "ann_id", "source_dataset", "answer_level"))


def _p2(spark: SparkSession, d: str) -> dict[str, mixture.Mixture]:
    mix = table(spark, d, "mix_targets")
    return {field: mixture.mixture(table(spark, d, name), key, field, stratum, mix, field) for name, key, field, stratum in MIXTURES}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    short = [(field, c) for field, m in _p2(spark, d).items() for c, lacking in m.plan.lacking.items() if lacking > 0]
    return spark.createDataFrame(short, "field_name string, category string")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    rows = [(field, *row) for field, m in _p2(spark, d).items() for row in m.report()]
    return spark.createDataFrame(rows, "field_name string, category string, pool_records long, wanted long, drawn long, lacking long")


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    drawn = [m.sample().select(F.lit(field).alias("field_name"), F.col("key").alias("record_key"), "category", "stratum") for field, m in _p2(spark, d).items()]
    return drawn[0].unionByName(drawn[1])


def p2_drawn(spark: SparkSession, d: str) -> DataFrame:
    """For each category the rows of the sample, and how many of them are there twice or not in the pool."""
    parts = []
    for field, m in _p2(spark, d).items():
        sample = written(m.sample(), "sample")
        n = sample.groupBy("category").agg(F.count(F.lit(1)).alias("drawn"), (F.count(F.lit(1)) - F.count_distinct("key")).alias("twice"))
        strange = sample.join(m.pool, ["key", "category"], "left_anti").groupBy("category").agg(F.count(F.lit(1)).alias("strange"))
        parts.append(n.join(strange, "category", "left").select(F.lit(field).alias("field_name"), "category", "drawn", "twice", F.coalesce("strange", F.lit(0)).alias("strange")))
    return parts[0].unionByName(parts[1])


def _p3(spark: SparkSession, d: str) -> dict[str, copies.Collapsed]:
    raw = copies.json_fields(table(spark, d, "raw_qa_records"), "record_id", "payload")
    return {
        "bootstrap_tuples": copies.collapse(table(spark, d, "bootstrap_tuples"), "ann_id", copies.Identity(("image_id",), ("anchor_label", "answer_normalized"), "answer_normalized")),
        "ocr_qa_dataset": copies.collapse(table(spark, d, "ocr_qa_dataset"), "sample_id", copies.Identity(("image_id",), ("question", "answer"), "answer")),
        "raw_qa_records": copies.collapse(raw, "record_id", copies.Identity((), copies.JSON_FIELDS)),
    }


def _named(parts: dict[str, DataFrame]) -> DataFrame:
    a, *rest = [df.select(F.lit(name).alias("table_name"), "*") for name, df in parts.items()]
    for b in rest:
        a = a.unionByName(b)
    return a


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _named({name: copies.copy_pairs(c) for name, c in _p3(spark, d).items()})


def p3_records(spark: SparkSession, d: str) -> DataFrame:
    return _named({name: copies.collapsed_records(c) for name, c in _p3(spark, d).items()})


def p6_top(spark: SparkSession, d: str) -> DataFrame:
    top = topn.top_of_table(table(spark, d, "bootstrap_tuples"), "image_id", "ann_id", "score", "produced_at", 3)
    return top.select(F.col("group_key").alias("image_id"), F.col("item_key").alias("ann_id"), "score", "rank")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_top(spark, d).select("image_id", "ann_id")


def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(table(spark, d, "readings")).found()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_nodes(spark, d).select("image_id", "node_id", "text_normalized")


def p4_unanimous(spark: SparkSession, d: str) -> DataFrame:
    """The nodes on which all readers agree, one reader included."""
    agreeing = F.coalesce(F.col("agreeing"), F.lit(1.0))
    return p4_nodes(spark, d).where(agreeing == 1).select("image_id", "node_id", "text_normalized", "readers")


def p4_seen(spark: SparkSession, d: str) -> DataFrame:
    """The nodes with a text, and how many of them have one that a reader saw, a row each and a proper probability."""
    found = written(p4_nodes(spark, d), "found")
    cast = consensus.votes(table(spark, d, "readings")).select("image_id", "node_id", F.col("text").alias("text_normalized")).distinct()
    seen = found.join(cast, ["image_id", "node_id", "text_normalized"], "left_semi")
    proper = seen.where("probability > 0 and probability <= 1").agg(F.count_distinct("image_id", "node_id").alias("seen")).first()["seen"]
    return found.agg(F.count(F.lit(1)).alias("nodes"), F.lit(proper).alias("seen"), F.sum("readers").alias("votes"))


def p4_readers(spark: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(table(spark, d, "readings")).reliability()


def p4_agreement(spark: SparkSession, d: str) -> DataFrame:
    found = consensus.chance_corrected(table(spark, d, "readings"))
    return found.select("readings", *(F.round(c, 9).alias(c) for c in ("observed", "by_chance", "alpha")))


SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def _p5(spark: SparkSession, d: str) -> splits.Splits:
    tuples = table(spark, d, "bootstrap_tuples")
    groups = splits.groups_of(tuples, table(spark, d, "source_registry"), table(spark, d, "image_links"))
    return splits.split(tuples, groups, "answer_level", SHARES)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.tied_pairs(_p5(spark, d).images())


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    return _p5(spark, d).tuples().drop("label")


def p5_balance(spark: SparkSession, d: str) -> DataFrame:
    """For each split and label: the pool's rows, whether the split's share of them and of all rows is within
    a point, or two rows, of what it should be, and whether its groups are in no other split."""
    s = _p5(spark, d)
    have = written(s.balance(), "balance")  # at most splits x LABELS rows
    most = s.tuples().groupBy("group_id").agg(F.count_distinct("split").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    label, sizes = have.groupBy("label").agg(F.sum("rows").alias("pool_rows")), have.groupBy("split").agg(F.sum("rows").alias("size"))
    # a row a label; in one select with the explode, the sum would be over its rows
    label = label.withColumn("pool", F.sum("pool_rows").over(Window.partitionBy(F.lit(0))))
    should = F.explode(F.array(*(F.struct(F.lit(k).alias("split"), F.lit(v).alias("share")) for k, v in SHARES.items())))
    grid = label.select("label", "pool_rows", "pool", should.alias("s")).select("label", "pool_rows", "pool", "s.*").join(F.broadcast(sizes), "split", "left")
    found = grid.join(have.withColumnsRenamed({"split": "_s", "label": "_l"}), (F.col("split") == F.col("_s")) & F.col("label").eqNullSafe(F.col("_l")), "left")
    size = F.coalesce("size", F.lit(0))
    near = lambda x, of: F.abs(x) <= F.greatest(of * 0.01, F.lit(2.0))
    label_off = F.coalesce("rows", F.lit(0)) - F.col("pool_rows") / F.col("pool") * size
    return found.select("split", "label", "pool_rows", near(label_off, size).alias("label_share_kept"), near(size - F.col("share") * F.col("pool"), F.col("pool")).alias("share_kept"), F.lit(most == 1).alias("groups_whole"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def _p7(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(_documents(spark, d), "doc_id", "text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_keys(_p7(spark, d)).select(F.col("key").alias("doc_id"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d).withColumnRenamed("key", "doc_id")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(_p7(spark, d))


def p7_audit(spark: SparkSession, d: str) -> DataFrame:
    return packing.audit(_p7(spark, d))


def _p8(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(_documents(spark, d), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _p8(spark, d).select("doc_id", "item_id")


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    return leakage.removal_spans(_p8(spark, d))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_p8(spark, d))


def _p9(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(_documents(spark, d), "doc_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.above_limit(_p9(spark, d)).select("doc_id")


def p9_measures(spark: SparkSession, d: str) -> DataFrame:
    return repetition.measures(_documents(spark, d), "doc_id", "text").select("doc_id", "words", "repeated_words", "repeated_share")


def p9_posteriors(spark: SparkSession, d: str) -> DataFrame:
    documents = _p9(spark, d)
    return documents.select("doc_id", *(c for c in documents.columns if c.startswith("vote_")), "posterior")


def p9_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """How many documents there are and are above the limit, and whether nine tenths of these are chosen by
    the posterior alone, nine tenths of the chosen are above, and none is lost."""
    a = repetition.accuracy(_p9(spark, d))
    lost = F.col("above_limit") - F.col("both") - F.col("doubtful_above")
    return a.select("documents", "above_limit", (F.col("both") >= 0.9 * F.col("above_limit")).alias("recall_reached"), (F.col("both") >= 0.9 * F.col("chosen")).alias("precision_reached"), lost.alias("lost"))


QUERIES = {name: f for name, f in list(globals().items()) if name[:1] == "p" and name[1:2].isdigit()}
