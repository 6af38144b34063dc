"""Statistics and scores of a question-answer set.

Each statistic is one aggregation to one row or a few; the scores are expressions over such rows.
Points, targets and weights of the scores are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphloom.functions.normalize import plain_answer, strip
from glyphloom.session import written

QUESTION_TYPES = ("DIRECT_READ", "YES_NO", "REVERSE_GROUND", "TEXT_PROPERTY", "ANCHOR_PROPERTY")


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def entropy(counts: DataFrame, n: str, by: list[str]) -> DataFrame:
    """(by..., entropy): of the counts n, with the natural logarithm: ln N - sum(n ln n) / N."""
    total = F.sum(n)
    value = F.ln(total) - F.sum(F.col(n) * F.ln(F.col(n).cast("double"))) / total
    return counts.where(F.col(n) > 0).groupBy(*by).agg(F.greatest(value, F.lit(0.0)).alias("entropy"))


def answer_distribution(rows: DataFrame, top: int = 10) -> DataFrame:
    """One row: how spread the answers are. rows: answer, question_type.

    total_answers is 1 for an empty set, as a divisor."""
    answer = F.nullif(F.col("answer"), F.lit(""))
    counts = rows.where(answer.isNotNull()).groupBy(F.lower(strip(F.col("answer"))).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    firsts = counts.orderBy(F.desc("n"), "a").limit(top)
    tops = firsts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("top1"), F.coalesce(F.sum("n"), F.lit(0)).alias("top10"))
    whole = counts.agg(F.greatest(F.coalesce(F.sum("n"), F.lit(0)), F.lit(1)).alias("total_answers"), F.count(F.lit(1)).alias("unique_answers"), (F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln(F.col("n").cast("double"))) / F.sum("n")).alias("h"))
    yes_no = F.upper(F.coalesce("question_type", F.lit(""))) == "YES_NO"
    yes = rows.agg(F.count(F.when(yes_no & (F.lower(strip(F.col("answer"))) == "yes"), 1)).alias("yes"), F.greatest(F.count(F.when(yes_no, 1)), F.lit(1)).alias("asked"))
    one = reduce(lambda a, b: a.join(F.broadcast(b)), (tops, yes), whole)  # one row each
    rate = F.col("yes") / F.col("asked")
    return one.select("total_answers", "unique_answers", F.bround(rate, 4).alias("yesno_yes_rate"), F.bround(1 - rate, 4).alias("yesno_no_rate"), F.bround(F.col("top1") / F.col("total_answers"), 4).alias("top1_concentration"), F.bround(F.col("top10") / F.col("total_answers"), 4).alias("top10_concentration"), F.bround(F.coalesce("h", F.lit(0.0)), 4).alias("answer_entropy"))


def top_answers(rows: DataFrame, n: int = 10) -> DataFrame:
    """(answer, rows): the most frequent answers, ties in the order of the alphabet."""
    a = F.lower(strip(F.col("answer"))).alias("answer")
    return rows.where("answer is not null and answer <> ''").groupBy(a).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "answer").limit(n)


def anchor_coverage(rows: DataFrame) -> DataFrame:
    """One row: how many different anchors an image's questions use. rows: image_id, anchor_label.

    The median is the upper one: of an even number of images, the greater of the two in the middle."""
    label = F.nullif(F.lower(strip(F.col("anchor_label"))), F.lit(""))
    images = rows.where("image_id is not null and image_id <> ''").select("image_id", label.alias("label")).distinct().groupBy("image_id").agg(F.count("label").alias("n"))
    # the histogram of n is small, the images need no sorting
    sizes = images.groupBy("n").agg(F.count(F.lit(1)).alias("images"))
    whole = sizes.agg(F.coalesce(F.sum("images"), F.lit(0)).alias("images"), F.sum(F.col("n") * F.col("images")).alias("anchors"), F.coalesce(F.sum(F.when(F.col("n") >= 2, F.col("images"))), F.lit(0)).alias("several"), F.array_sort(F.collect_list(F.struct("n", "images"))).alias("h"))
    add = lambda s, x: F.struct((s["seen"] + x["images"]).alias("seen"), F.when((s["seen"] <= F.floor(F.col("images") / 2)) & (s["seen"] + x["images"] > F.floor(F.col("images") / 2)), x["n"]).otherwise(s["at"]).alias("at"))
    middle = F.aggregate("h", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("at")), add)["at"]
    n = F.col("images")
    return whole.select(n, F.bround(_share(F.col("anchors"), n), 3).alias("mean_unique_anchors"), middle.cast("double").alias("median_unique_anchors"), F.col("several").alias("images_with_multiple_anchors"), F.bround(_share(F.col("several"), n), 4).alias("images_with_multiple_anchors_rate"))


def type_diversity(rows: DataFrame) -> DataFrame:
    """One row: entropy of the question types by that of five even ones, at most 1, and the number of
    types with at least three rows. rows: question_type."""
    counts = rows.groupBy("question_type").agg(F.count(F.lit(1)).alias("n"))
    h = F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln(F.col("n").cast("double"))) / F.sum("n")
    return counts.agg(F.coalesce(F.least(h / F.ln(F.lit(5.0)), F.lit(1.0)), F.lit(0.0)).alias("type_diversity"), F.count(F.when(F.col("n") >= 3, 1)).alias("num_types_with_coverage"))


def row_counts(rows: DataFrame) -> DataFrame:
    """One row of conditional counts. rows: question_type, ambiguity_level, yesno_polarity, scope,
    frontier_correct (boolean, null where not scored)."""
    when = lambda c: F.count(F.when(c, 1))
    kind = F.col("question_type")
    types = [when(kind == t).alias(t.lower()) for t in QUESTION_TYPES]
    polarity = [when((kind == "YES_NO") & (F.col("yesno_polarity") == p)).alias(f"yesno_{p}") for p in ("positive", "negative")]
    scopes = [when((kind == "REVERSE_GROUND") & (F.col("scope") == s)).alias(f"reverse_{s}") for s in ("local", "global", "mixed")]
    return rows.agg(*types, *polarity, *scopes, when(F.col("ambiguity_level") == "high").alias("ambiguity_high"), when(F.col("frontier_correct")).alias("frontier_right"), F.count("frontier_correct").alias("frontier_scored"))


def q3_score() -> Column:
    """Over the columns of run_quality: precision, coverage and yield, less failures by rate."""
    c, made = F.col, F.greatest(F.col("generated_qas"), F.lit(1))
    least = lambda x, most: F.least(x, F.lit(float(most)))
    gain = 30.0 * c("qa_accept_rate") + 20.0 * least(c("images_with_final_rows") / 40.0, 1)
    gain = gain + 10.0 * least(c("accepted_qas") / F.greatest(c("images_with_final_rows"), F.lit(1)) / 3.5, 1)
    gain = gain + 5.0 * c("type_diversity") + 2.0 * least(c("num_types_with_coverage") / 4.0, 1)
    gain = gain + 3.0 * least(c("reverse_local"), 5) + 1.5 * least(c("reverse_mixed"), 5) + 0.4 * least(c("yesno_negative"), 10)
    loss = {"anchor_missing": 15.0, "ambiguous_grounding": 10.0, "reverse_ambiguous": 8.0, "reverse_invalid": 5.0, "validation_failed": 2.0}
    return F.bround(gain - reduce(lambda a, b: a + b, (w * (c(n) / made) for n, w in loss.items())), 2)


def linear_score() -> Column:
    """Over the columns of run_quality: the older score, by counts."""
    weights = {"accepted_qas": 0.20, "images_with_final_rows": 0.55, "anchor_missing": -0.45, "ambiguous_grounding": -0.60, "reverse_ambiguous": -0.50, "reverse_invalid": -0.40, "validation_failed": -0.10, "yesno_negative": 0.15, "reverse_local": 0.15, "reverse_mixed": 0.08, "qa_accept_rate": 15.0, "anchor_missing_rate": -4.0}
    return F.bround(reduce(lambda a, b: a + b, (F.col(n) * w for n, w in weights.items())) + 3.0 * (1.0 - F.col("high_ambiguity_fraction")), 2)


def steps(x: Column, *points: tuple[float, float, float]) -> Column:
    """Piecewise linear: (from, value there, slope) of pieces in rising order; 0 before the first."""
    out = F.lit(0.0)
    for start, value, slope in points:
        out = F.when(x >= start, value + (x - start) * slope).otherwise(out)
    return out


def q4_score() -> Column:
    """Over the columns of run_quality and of answer_distribution, anchor_coverage and text_leaky_rate:
    nine components; 0 for an empty set. A statistic that is null or 0 counts as not given."""
    c = F.col
    least = lambda x: F.least(x, F.lit(1.0))
    given = lambda name, default: F.coalesce(F.nullif(c(name).cast("double"), F.lit(0.0)), F.lit(default))
    accepted = F.greatest(c("accepted_qas"), F.lit(1))
    grounded = steps(c("reverse_ground") / accepted, (0.02, 0.0, 5.0 / 0.03), (0.05, 5.0, 10.0 / 0.03), (0.08, 15.0, 10.0 / 0.04), (0.12, 25.0, 0.0))
    scopes = [c(f"reverse_{s}") for s in ("local", "global", "mixed")]
    total = reduce(lambda a, b: a + b, scopes)
    present = reduce(lambda a, b: a + b, (F.when(s > 0, 1).otherwise(0) for s in scopes))
    spread = reduce(lambda a, b: a + b, (F.when(s > 0, -(s / total) * F.ln(s / total)).otherwise(0.0) for s in scopes))
    mixed = F.when(total > 0, present / 3.0 * 5.0 + F.when(present >= 2, spread / F.ln(F.lit(3.0)) * 5.0).otherwise(0.0)).otherwise(0.0)
    answers = least(given("answer_entropy", 0.0) / 4.0) * 5.0 + least(given("unique_answers", 0.0) / 100.0) * 5.0
    anchors = least(given("mean_unique_anchors", 0.0) / 1.8) * 5.0 + least(given("images_with_multiple_anchors_rate", 0.0) / 0.30) * 5.0
    balance = F.greatest(1.0 - F.abs(given("yesno_yes_rate", 0.5) - 0.5) * 2.0, F.lit(0.0)) * 5.0
    leaky, vague = given("text_leaky_rate", -1.0), c("high_ambiguity_fraction")
    down = lambda x, free, bend, slope: F.when(x <= free, 5.0).when(x <= bend, 5.0 - (x - free) / 0.15 * 3.0).otherwise(F.greatest(2.0 - (x - bend) / slope * 2.0, F.lit(0.0)))
    text = F.when(leaky < 0, 2.5).otherwise(down(leaky, 0.35, 0.50, 0.30))
    parts = (least(c("accepted_qas") / 300.0) * 20.0, least(c("images_with_final_rows") / 120.0) * 10.0, grounded, mixed, answers, anchors, balance, text, down(vague, 0.60, 0.75, 0.25))
    return F.when(c("accepted_qas") > 0, F.bround(reduce(lambda a, b: a + b, parts), 2)).otherwise(0.0)


def run_quality(summary: DataFrame, rows: DataFrame, statistics: list[DataFrame] | None = None) -> DataFrame:
    """One row: the summary's columns with counts, rates and scores.

    summary (one row): accepted_qas, generated_qas, qa_accept_rate, images_with_final_rows and the
    failure counts anchor_missing, ambiguous_grounding, reverse_ambiguous, reverse_invalid,
    validation_failed. statistics: one-row tables for the score of answers and anchors; without
    them these components count as not given."""
    optional = ["answer_entropy", "unique_answers", "mean_unique_anchors", "images_with_multiple_anchors_rate", "yesno_yes_rate", "text_leaky_rate"]
    one = reduce(lambda a, b: a.join(F.broadcast(b)), [row_counts(rows), type_diversity(rows), *(statistics or [])], summary)
    one = one.withColumns({n: F.lit(None).cast("double") for n in optional if n not in one.columns})
    accepted, made = F.col("accepted_qas"), F.col("generated_qas")
    one = one.withColumns({"high_ambiguity_fraction": F.when(accepted > 0, F.col("ambiguity_high") / accepted).otherwise(1.0), "anchor_missing_rate": F.when(made > 0, F.col("anchor_missing") / made).otherwise(0.0)})
    mean = _share(F.col("frontier_right"), F.col("frontier_scored"))
    first = F.bround(mean * F.sqrt(F.col("frontier_scored").cast("double")), 4)
    one = one.withColumns({"quality_score": linear_score(), "q3_score": q3_score(), "q4_score": q4_score(), "inline_frontier_mean": F.bround(mean, 4), "precision_first_score": first})
    return one.withColumn("sweep_score", F.when(F.col("frontier_scored") > 0, F.col("precision_first_score")).otherwise(F.col("q3_score")))


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(bin, rows): counts below each edge and above the last, also empty ones."""
    bins = len(edges) + 1
    at = F.lit(0)
    for e in edges:
        at = at + F.when(F.col(value) >= e, 1).otherwise(0)
    n = df.where(F.col(value).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(n, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("rows"))


#: Buckets of a histogram that finds a rank, and distinct values of one bucket that a task may sort.
RANK_BUCKETS, RANK_VALUES = 1024, 200_000


def ranked_values(df: DataFrame, value: str, by: list[str], shares: dict[str, float], most: int = RANK_VALUES) -> DataFrame:
    """(by..., each share's quantile), interpolated between ranks; exact, without gathering a group.

    The values of a group are counted in buckets; those about a sought rank are narrowed by further
    histograms until few distinct values are left in them, and only these are sorted. NaN counts as greatest."""
    key = F.struct(*(F.col(c) for c in by)) if by else F.lit(0)
    values = df.where(F.col(value).isNotNull()).groupBy(key.alias("_g"), F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    values = written(values, "values")
    stats = values.groupBy("_g").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_d"))
    wanted = F.explode(F.array(*(F.struct(F.lit(n).alias("_q"), F.lit(p).alias("_p"), F.lit(up).alias("_up")) for n, p in shares.items() for up in (0, 1))))
    at = F.col("_p") * (F.col("_all") - 1)
    asks = stats.select("_g", "_lo", "_hi", "_all", "_d", wanted.alias("w")).select("_g", "_lo", "_hi", "_all", "_d", "w.*")
    asks = asks.withColumn("_rank", F.when(F.col("_up") == 1, F.ceil(at)).otherwise(F.floor(at))).withColumn("_before", F.lit(0).cast("long"))
    asks, same = written(asks, "asks"), ["_g", "_q", "_up"]
    inside = lambda: values.join(asks, "_g").where("_v >= _lo and _v <= _hi")
    while not asks.where((F.col("_d") > most) & (F.col("_hi") > F.col("_lo"))).isEmpty():
        width = F.col("_hi") / RANK_BUCKETS - F.col("_lo") / RANK_BUCKETS
        bucket = F.least(F.floor(F.col("_v") / width - F.col("_lo") / width), F.lit(RANK_BUCKETS - 1))
        counts = inside().groupBy(*same, "_p", "_all", "_rank", "_before", F.when(width > 0, bucket).otherwise(0).alias("_b")).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upward = Window.partitionBy(*same).orderBy("_b")  # at most RANK_BUCKETS rows
        counts = counts.withColumn("_sum", F.sum("_n").over(upward) + F.col("_before"))
        found = counts.where("_rank < _sum and _rank >= _sum - _n")
        narrowed = found.select("_g", "_lo", "_hi", "_all", "_d", "_q", "_p", "_up", "_rank", (F.col("_sum") - F.col("_n")).alias("_before"))
        asks = written(narrowed, "asks")
    upward = Window.partitionBy(*same).orderBy("_v")
    placed = inside().withColumn("_sum", F.sum("_n").over(upward) + F.col("_before")).where("_rank < _sum and _rank >= _sum - _n")
    part = F.max("_p") * (F.max("_all") - 1) - F.floor(F.max("_p") * (F.max("_all") - 1))
    low, high = F.max(F.when(F.col("_up") == 0, F.col("_v"))), F.max(F.when(F.col("_up") == 1, F.col("_v")))
    each = placed.groupBy("_g", "_q").agg((low + (high - low) * part).alias("_x"))
    wide = each.groupBy("_g").pivot("_q", list(shares)).agg(F.max("_x"))
    return wide.select("_g.*", *shares) if by else wide.select(*shares)


def summary_of(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """(by..., count, min, p25, median, p75, max, mean), quantiles interpolated, 4 decimals."""
    by = by or []
    r = lambda c: F.bround(c, 4)
    quantiles = ranked_values(df, value, by, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    plain = df.groupBy(*by).agg(F.count(value).alias("count"), r(F.min(value)).alias("min"), r(F.max(value)).alias("max"), r(F.avg(value)).alias("mean"))
    q = quantiles.withColumnsRenamed({c: f"_{c}" for c in by})
    both = plain.join(q, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.lit(True)), "left")
    return both.select(*by, "count", "min", r(F.col("p25")).alias("p25"), r(F.col("median")).alias("median"), r(F.col("p75")).alias("p75"), "max", "mean")


def resolvability_stats(nodes: DataFrame) -> DataFrame:
    """(source, total, accepted, dropped, drop_rate): by source and, with source null, over all."""
    ok = F.coalesce("resolvable", F.lit(False))
    named = nodes.select(F.coalesce("source_dataset", F.lit("unknown")).alias("source"), ok.alias("ok"))
    return named.rollup("source").agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("ok"), 1)).alias("accepted"), F.count(F.when(~F.col("ok"), 1)).alias("dropped"), F.avg(F.when(F.col("ok"), 0.0).otherwise(1.0)).alias("drop_rate"))


def with_uniqueness(tuples: DataFrame) -> DataFrame:
    """tuples with unique: whether no other of the image has the answer. Answers are counted with a
    map-side combine, so an image with a large part of all rows stays spread."""
    from glyphloom.operators.skew import lookup_join

    keyed = tuples.withColumn("_a", plain_answer(F.col("answer")))
    n = keyed.groupBy("image_id", "_a").agg(F.count(F.lit(1)).alias("_n"))
    return lookup_join(keyed, n, ["image_id", "_a"], "left").withColumn("unique", F.coalesce(F.col("_n") == 1, F.lit(False))).drop("_a", "_n")
