"""Answers of models as text: JSON that may be fenced, cut off or wrapped in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphloom.functions.normalize import literal_map, strip, text_of, without_fences

BOXES = "array<struct<bbox_2d: array<double>, label: string>>"
# Short names of model providers.
PROVIDERS = {"google": "gemini", "local": "ollama"}


def salvaged_boxes(c: Column, schema: str = BOXES, key: str = "bbox_2d") -> Column:
    """The objects in a model's answer: of the whole text, from its first [ or {, or every object that
    names ``key``; empty if there is none. A single object counts as a list of one."""
    t = without_fences(c)
    options = {"mode": "PERMISSIVE"}
    parse = lambda s: F.from_json(s, schema, options)
    at = lambda mark: F.when(F.contains(t, F.lit(mark)), F.substring(t, F.instr(t, mark), F.length(t)))
    filled = lambda xs: F.filter(xs, lambda x: x.isNotNull() & x[key].isNotNull())
    some = lambda xs: F.when(F.size(filled(xs)) > 0, filled(xs))
    one = lambda s: some(parse(F.concat(F.lit("["), s, F.lit("]"))))
    whole = F.when(F.startswith(t, F.lit("{")), one(t)).otherwise(some(parse(t)))
    pieces = F.regexp_extract_all(t, F.lit(r"\{[^{}]*\"" + key + r"\"[^{}]*\}"), F.lit(0))
    single = F.transform(pieces, lambda p: F.try_element_at(parse(F.concat(F.lit("["), p, F.lit("]"))), F.lit(1)))
    return F.coalesce(whole, some(parse(at("["))), one(at("{")), filled(single))


def first_object(c: Column, schema: str) -> Column:
    """From the first { to the last }, parsed; null if that is no object."""
    return F.from_json(F.nullif(F.regexp_extract(text_of(c), r"(?s)\{.*\}", 0), F.lit("")), schema, {"mode": "PERMISSIVE"})


def ambiguity_reply(c: Column) -> Column:
    """struct<ambiguous, confidence, reason, parse_ok> of an object or of plain true, false, yes, no.

    confidence is kept within 0 and 1, and 1 for a plain word; a text that is neither is not ok."""
    obj = first_object(c, "ambiguous string, confidence double, reason string")
    word = F.lower(F.regexp_extract(text_of(c), r"(?i)\b(true|false|yes|no)\b", 1))
    said = F.lower(obj["ambiguous"])
    known = said.isin("true", "false")
    plain = word != ""
    flag = F.when(known, said == "true").when(plain, word.isin("true", "yes"))
    sure = F.when(known, F.least(F.greatest(F.coalesce(obj["confidence"], F.lit(1.0)), F.lit(0.0)), F.lit(1.0))).when(plain, 1.0)
    return F.struct(flag.alias("ambiguous"), sure.alias("confidence"), F.when(known, obj["reason"]).alias("reason"), F.coalesce(known | plain, F.lit(False)).alias("parse_ok"))


def first_text_part(c: Column) -> Column:
    """The first text of a generated reply's first candidate."""
    return F.get_json_object(c, "$.candidates[0].content.parts[0].text")


def model_spec(c: Column) -> Column:
    """struct<provider, model> of provider:model."""
    parts = F.split(strip(c), ":", 2)
    provider = F.lower(F.try_element_at(parts, F.lit(1)))
    return F.struct(F.coalesce(F.element_at(literal_map(PROVIDERS), provider), provider).alias("provider"), F.try_element_at(parts, F.lit(2)).alias("model"))


def inventory(rows: Column, most: int = 12) -> Column:
    """struct<caption, labels, regions> of an array of structs label, box."""
    named = F.filter(F.coalesce(rows, F.array().cast("array<struct<label: string, box: array<double>>>")), lambda r: strip(r["label"]) != "")
    labels = F.array_distinct(F.transform(named, lambda r: strip(r["label"])))
    boxed = F.filter(named, lambda r: F.size(r["box"]) >= 4)
    regions = F.transform(boxed, lambda r: F.struct(strip(r["label"]).alias("label"), F.transform(F.slice(r["box"], 1, 4), lambda v: F.bround(v, 2)).alias("box")))
    return F.struct(F.array_join(F.slice(labels, 1, 6), "; ").alias("caption"), labels.alias("labels"), F.slice(regions, 1, most).alias("regions"))
