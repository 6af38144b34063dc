"""Scores of predicted against gold answers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphloom.functions.normalize import answer_by_type, inline_answer_by_type, tokens, without_accents, without_tail_marks

# Words that tell nothing in a description of a place.
IDLE_WORDS = (
    "a", "an", "the", "in", "on", "at", "of", "to", "is", "it", "be", "as", "and", "or", "for", "with", "by", "from", "this", "that",
    "are", "was", "not", "but", "if", "its", "into", "do", "so", "area", "image", "text", "near", "around",
)


def shared_count(a: Column, b: Column) -> Column:
    """How many items two arrays share, each as often as both have it."""
    often = lambda xs, w: F.size(F.filter(xs, lambda x: x == w))
    # the arrays travel in the state: a lambda may not hold what a Python function made
    start = F.struct(F.lit(0).alias("n"), a.alias("a"), b.alias("b"))
    add = lambda s, w: F.struct((s["n"] + F.least(often(s["a"], w), often(s["b"], w))).alias("n"), s["a"].alias("a"), s["b"].alias("b"))
    return F.aggregate(F.array_intersect(a, b), start, add, lambda s: s["n"])


def f1(gold: Column, said: Column) -> Column:
    """F1 of two arrays of words; 0 if either is empty."""
    n = shared_count(gold, said)
    return F.when(n > 0, 2.0 * n / (F.size(gold) + F.size(said))).otherwise(0.0)


def word_f1(gold: Column, said: Column) -> Column:
    return f1(tokens(without_accents(gold)), tokens(without_accents(said)))


def content_f1(gold: Column, said: Column) -> Column:
    """Of the words that tell something."""
    telling = lambda c: F.filter(tokens(c), lambda w: ~w.isin(*IDLE_WORDS) & (F.length(w) > 1))
    return f1(telling(gold), telling(said))


def partly_read(gold: Column, said: Column) -> Column:
    """Whether a reading is right though it holds more or less than was asked for.

    Words agree without a plural s. The reading holds all gold words; or it is at most three words
    of them; or one side is the other's words written as one. Gold of under three characters needs
    only occur in the reading."""
    trimmed = without_tail_marks(gold)
    g, p = without_accents(trimmed), without_accents(said)
    gw, pw = tokens(g), tokens(p)
    stems = lambda ws: F.transform(ws, lambda w: F.when(F.length(w) > 3, F.regexp_replace(w, "s$", "")).otherwise(w))
    inside = lambda a, b: F.size(F.array_except(stems(a), stems(b))) == 0
    glued = lambda one, whole, many: (F.size(one) == 1) & (F.size(many) >= 2) & (F.length(whole) >= 4) & (whole == F.array_join(many, ""))
    long = (F.size(gw) > 0) & (F.size(pw) > 0) & (inside(gw, pw) | ((F.size(pw) <= 3) & inside(pw, gw)) | glued(gw, g, pw) | glued(pw, p, gw))
    return F.coalesce(F.when(trimmed == "", F.lit(False)).when(F.length(trimmed) < 3, F.contains(p, g)).otherwise(long), F.lit(False))


def scored(gold: Column, said: Column, question_type: Column, answer_type: Column, inline: bool = False) -> Column:
    """struct of normal forms and exact, partial, semantic and soft correctness.

    inline: with the stricter ASCII normal form."""
    normal = inline_answer_by_type if inline else answer_by_type
    kind = F.upper(F.trim(F.coalesce(question_type, F.lit(""))))
    g, p = normal(gold, answer_type), normal(said, answer_type)
    exact = (g == p) | (without_accents(g) == without_accents(p))
    partial = (kind == "DIRECT_READ") & ~exact & partly_read(g, p)
    words = F.when(kind == "REVERSE_GROUND", content_f1(g, p)).otherwise(0.0)
    semantic = words >= 0.5
    return F.struct(p.alias("prediction_norm"), g.alias("gold_norm"), exact.alias("exact_correct"), partial.alias("partial_correct"), semantic.alias("semantic_correct"), F.bround(words, 4).alias("word_f1"), (exact | partial | semantic).alias("soft_correct"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1))


def all_distinct(questions: Column, most: float = 0.7) -> Column:
    """Whether no two of the questions share more than this part of their words."""
    sets = F.transform(questions, lambda q: F.array_distinct(tokens(F.lower(q))))
    indexed = F.transform(sets, lambda s, i: F.named_struct(F.lit("i"), i, F.lit("s"), s))
    return ~F.exists(indexed, lambda a: F.exists(indexed, lambda b: (a["i"] < b["i"]) & (jaccard(a["s"], b["s"]) > most)))
