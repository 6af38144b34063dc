"""Normal forms of answers, questions and labels, and predicates on texts, as column expressions.

White space and letters are those of Unicode throughout: Spark's own trim and \\s know only ASCII.
Null texts count as empty in normal forms, and as failing in predicates, unless said otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = r"[\s\p{Z}]"
#: The same characters.
SPACES = "\t\n\x0b\f\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Neither letter, digit, underscore nor white space.
PUNCTUATION = r"[^\p{L}\p{N}_\s\p{Z}]"

# Words for numbers, and the articles that answers drop.
NUMBER_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}
ARTICLES = ("a", "an", "the")
# Plurals that follow no rule.
IRREGULAR_PLURALS = {"person": "people", "man": "men", "woman": "women", "child": "children", "foot": "feet", "tooth": "teeth", "mouse": "mice"}
# Short forms of location phrases.
SHORT_LOCATIONS = {
    "upper-left area of the image": "upper left of the image",
    "upper-right area of the image": "upper right of the image",
    "lower-left area of the image": "lower left of the image",
    "lower-right area of the image": "lower right of the image",
    "top-center area of the image": "top center of the image",
    "bottom-center area of the image": "bottom center of the image",
    "center-left area of the image": "left side of the image",
    "center-right area of the image": "right side of the image",
    "center area of the image": "center of the image",
}
# Fixed value: what looks like an address on the net.
ADDRESS = r"(?i)(https?://|www\.|\.com\b|\.net\b|\.org\b|@)"


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at the ends."""
    return F.btrim(text_of(c), F.lit(SPACES))


def spaced(c: Column) -> Column:
    """Stripped, lower case, runs of white space as one blank."""
    return F.regexp_replace(F.lower(strip(c)), f"{SPACE}+", " ")


def tokens(c: Column) -> Column:
    """array<string>: what white space separates."""
    return F.filter(F.split(text_of(c), f"{SPACE}+"), lambda x: x != "")


def plain_answer(c: Column) -> Column:
    """Stripped, lower case, single blanks, punctuation dropped."""
    return strip(F.regexp_replace(spaced(c), PUNCTUATION, ""))


def vqa_answer(c: Column) -> Column:
    """Lower case, punctuation but ' as a blank, number words as digits, articles dropped."""
    words = tokens(F.regexp_replace(F.lower(text_of(c)), r"[^\p{L}\p{N}_\s\p{Z}']", " "))
    digits = F.transform(words, lambda w: F.coalesce(F.element_at(literal_map(NUMBER_WORDS), w), w))
    return F.array_join(F.filter(digits, lambda w: ~w.isin(*ARTICLES)), " ")


def text_answer(c: Column) -> Column:
    """Lower case, straight quotes, single blanks."""
    return spaced(F.translate(text_of(c), "’‘“”", "''\"\""))


def answer_by_type(answer: Column, kind: Column) -> Column:
    """The normal form in which predictions meet gold answers, by the answer's type."""
    return F.when(F.lower(strip(kind)).isin("yes", "no", "number"), vqa_answer(answer)).otherwise(text_answer(answer))


@F.pandas_udf(StringType())
def compatible(s: pd.Series) -> pd.Series:
    """Unicode NFKC; Spark has no function for it. ASCII texts are their own normal form."""
    import unicodedata

    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(StringType())
def without_accents(s: pd.Series) -> pd.Series:
    """NFKC, then without combining marks; ASCII texts pass unchanged."""
    import unicodedata

    def bare(t: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFD", unicodedata.normalize("NFKC", t)) if unicodedata.category(c) != "Mn")

    return s.map(lambda t: t if t is None or t.isascii() else bare(t), na_action="ignore")


def inline_text_answer(c: Column) -> Column:
    """NFKC, lower case, all but ASCII letters and digits as a blank."""
    return spaced(F.regexp_replace(F.lower(compatible(text_of(c))), r"[^a-z0-9\s\p{Z}]", " "))


def inline_vqa_answer(c: Column) -> Column:
    """The same, with the spellings of yes and no folded."""
    t = inline_text_answer(c)
    return F.when(t.isin("yes", "yeah", "y"), "yes").when(t.isin("no", "nope", "n"), "no").otherwise(t)


def inline_answer_by_type(answer: Column, kind: Column) -> Column:
    return F.when(F.lower(strip(kind)).isin("yes", "no", "number"), inline_vqa_answer(answer)).otherwise(inline_text_answer(answer))


def file_safe_id(c: Column) -> Column:
    return F.replace(c, F.lit("::"), F.lit("__"))


def group_id(node_ids: Column) -> Column:
    return F.concat(F.lit("group_"), F.array_join(node_ids, "_"))


def without_tail_marks(c: Column) -> Column:
    """Without closing brackets, stops and quotes at the end; stripped."""
    return strip(F.regexp_replace(text_of(c), r"[\]\[(.,;:!?)'\"]+$", ""))


def short_location(c: Column) -> Column:
    raw = strip(c)
    known = F.element_at(literal_map(SHORT_LOCATIONS), F.lower(raw))
    rest = F.regexp_replace(raw, r" (area|part) of the image", " of the image")
    for side in ("upper-left", "upper-right", "lower-left", "lower-right"):
        rest = F.regexp_replace(rest, rf"(?i)\b{side}\b", side.replace("-", " "))
    return F.coalesce(known, strip(F.regexp_replace(rest, f"{SPACE}+", " ")))


def plural(word: Column) -> Column:
    """Of one word, in the word's own case where the plural is irregular."""
    w = strip(word)
    low = F.lower(w)
    odd = F.element_at(literal_map(IRREGULAR_PLURALS), low)
    odd = F.when(w == low, odd).when(w == F.initcap(w), F.initcap(odd)).when(w == F.upper(w), F.upper(odd)).otherwise(odd)
    by_rule = F.when(low.rlike("[^aeiou]y$"), F.concat(F.substring(w, F.lit(1), F.length(w) - 1), F.lit("ies")))
    by_rule = by_rule.when(low.rlike("(s|x|z|ch|sh)$"), F.concat(w, F.lit("es"))).otherwise(F.concat(w, F.lit("s")))
    return F.when(w == "", "").otherwise(F.coalesce(odd, by_rule))


def plural_phrase(c: Column) -> Column:
    """With the last word in the plural."""
    parts = tokens(c)
    last = plural(F.try_element_at(parts, F.lit(-1)))
    return F.when(F.size(parts) == 0, "").otherwise(F.array_join(F.concat(F.slice(parts, 1, F.size(parts) - 1), F.array(last)), " "))


def distinct_by(items: Column, key) -> Column:
    """The items whose key isn't empty and not that of an earlier item, in order."""
    keyed = F.filter(F.transform(items, lambda x: F.struct(key(x).alias("k"), x.alias("x"))), lambda s: s["k"] != "")
    keys = F.transform(keyed, lambda s: s["k"])
    return F.transform(F.filter(keyed, lambda s, i: F.array_position(keys, s["k"]) == i + 1), lambda s: s["x"])


def distinct_labels(items: Column, most: int = 12) -> Column:
    """Lower case and stripped, the first of equal ones, at most so many."""
    low = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.lower(strip(x)))
    return F.slice(F.array_distinct(F.filter(low, lambda x: x != "")), 1, most)


def letters_and_digits(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"[^\p{L}\p{N}]", "")


def valid_text(c: Column) -> Column:
    """2 to 32 characters, at most 6 words, an ASCII letter or digit, and not one thin or repeated
    character alone."""
    t = strip(c)
    compact = letters_and_digits(t)
    dull = (F.length(compact) >= 4) & (compact.rlike(r"(?i)^[1il|]+$") | F.lower(compact).rlike(r"^(.)\1+$"))
    return F.length(t).between(2, 32) & (F.size(tokens(t)) <= 6) & ~dull & t.rlike("[A-Za-z0-9]")


def dull_text(c: Column) -> Column:
    """Four or more of one thin character."""
    return letters_and_digits(plain_answer(c)).rlike(r"^(1{4,}|l{4,}|i{4,})$")


def numeric_only(c: Column) -> Column:
    return F.regexp_replace(text_of(c), f"{SPACE}+", "").rlike(r"^\p{Nd}+$")


def text_kind(c: Column) -> Column:
    """numeric, alpha, alnum, or mixed for a text without letters and digits."""
    compact = letters_and_digits(plain_answer(c))
    return F.when(compact.rlike(r"^\p{Nd}+$"), "numeric").when(compact.rlike(r"^\p{L}+$"), "alpha").when(compact != "", "alnum").otherwise("mixed")


def letter_case(c: Column) -> Column:
    """empty, upper, lower, title or mixed, of the letters and digits."""
    t = letters_and_digits(c)
    cased = F.upper(t) != F.lower(t)
    rest = F.substring(t, F.lit(2), F.length(t))
    title = (F.substring(t, 1, 1) != F.lower(F.substring(t, 1, 1))) & (rest == F.lower(rest)) & (F.upper(rest) != rest)
    return F.when(t == "", "empty").when(cased & (t == F.upper(t)), "upper").when(cased & (t == F.lower(t)), "lower").when(title, "title").otherwise("mixed")


def case_tag(c: Column) -> Column:
    """numeric, alphanumeric, upper, lower or mixed, of all but white space."""
    t = F.regexp_replace(text_of(c), f"{SPACE}+", "")
    cased = F.upper(t) != F.lower(t)
    mixed = t.rlike(r"^[\p{L}\p{N}]+$") & ~t.rlike(r"^\p{L}+$")
    return F.when(t.rlike(r"^\p{Nd}+$"), "numeric").when(mixed, "alphanumeric").when(cased & (t == F.upper(t)), "upper").when(cased & (t == F.lower(t)), "lower").otherwise("mixed")


def blocked_answer(c: Column) -> Column:
    """Empty, like an address, or like a telephone number."""
    t = strip(c)
    phone = (F.length(F.regexp_replace(t, r"\P{Nd}", "")) >= 7) & t.rlike(r"[-()]")
    return (t == "") | t.rlike(ADDRESS) | phone


def one_edit_apart(a: Column, b: Column) -> Column:
    """Levenshtein distance exactly 1, given up beyond it."""
    return F.levenshtein(a, b, 1) == 1


def without_fences(c: Column) -> Column:
    """Without the fences that mark code."""
    t = F.regexp_replace(strip(c), r"(?i)^```json\s*", "")
    return strip(F.regexp_replace(F.regexp_replace(t, r"^```\s*", ""), r"\s*```$", ""))


def mentions(question: Column, phrases: Column) -> Column:
    """Whether the question holds one of the phrases."""
    return F.exists(F.coalesce(phrases, F.array().cast("array<string>")), lambda p: F.contains(spaced(question), spaced(p)))


def code_point_sum(c: Column) -> Column:
    return F.aggregate(F.split(text_of(c), ""), F.lit(0).cast("long"), lambda s, x: s + F.ascii(x))


def stable_choice(options: Column, seed: Column) -> Column:
    """One of the options by the code points of the seed; empty if there is none."""
    n = F.size(options)
    pick = F.try_element_at(options, (F.pmod(code_point_sum(seed), F.greatest(n, F.lit(1))) + 1).cast("int"))
    return F.when(n > 0, pick).otherwise("")
