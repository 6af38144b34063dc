from __future__ import annotations

import pytest
from glyphloom.functions import bins as B
from glyphloom.functions import geometry as G
from glyphloom.functions import labels as L
from glyphloom.functions import normalize as N
from glyphloom.functions import payloads as P
from glyphloom.functions import scoring as S
from glyphloom.functions.geometry import Box
from pyspark.sql import functions as F


def one(spark, function, *values, kind="string"):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {kind}" for i in range(len(values))))
    return df.select(function(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x


def box(*sides):
    return F.struct(*(F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), sides)))


@pytest.mark.parametrize(
    ("function", "text", "want"),
    [
        (N.plain_answer, " OPEN 24 HOURS! ", "open 24 hours"),
        (N.plain_answer, None, ""),
        (N.plain_answer, " Ünï Çode—x ", "ünï çodex"),
        (N.vqa_answer, "The two, red-cars!", "2 red cars"),
        (N.text_answer, "“It’s”\n fine", "\"it's\" fine"),
        (N.valid_text, "AB", True),
        (N.valid_text, "A", False),
        (N.valid_text, "1lIl|", False),
        (N.valid_text, "aaaa", False),
        (N.valid_text, "***", False),
        (N.valid_text, None, False),
        (N.plural_phrase, "red Person", "red People"),
        (N.plural_phrase, "city", "cities"),
        (N.plural_phrase, "big box", "big boxes"),
        (N.plural_phrase, "", ""),
        (N.short_location, "Upper-Left area of the image", "upper left of the image"),
        (N.blocked_answer, "www.x.com", True),
        (N.blocked_answer, "(555) 123-4567", True),
        (N.blocked_answer, "OPEN", False),
        (N.text_kind, "12:30", "numeric"),
        (N.letter_case, "Open", "title"),
        (N.case_tag, "A1", "alphanumeric"),
        (N.without_fences, '```json\n[1]\n```', "[1]"),
        (N.inline_vqa_answer, " Yeah! ", "yes"),
        (N.without_tail_marks, "REFRIGERATORS]", "REFRIGERATORS"),
        (N.without_accents, "CORAZÓN ﬁ", "CORAZON fi"),
        (L.color, "a dark blue and red can", "dark blue"),
        (L.vocabulary_label, "Blue bottle of beer", "blue bottle"),
        (L.vocabulary_label, "signs on a wall", "sign wall"),
        (L.vocabulary_label, "object detected", None),
        (L.vocabulary_label, "red baseball helmet", "red baseball helmet"),
        (L.open_label, "visible shiny kettles", "shiny kettles"),
        (L.open_label, "report bbox here", None),
        (L.is_useless, "light blue sky", True),
        (L.refers_to_text, "footer area text", True),
        (L.looks_copied, "DAN BROWN BREWING CO", True),
        (L.looks_copied, "red sign", False),
        (L.without_colors, "red cup", "cup"),
        (L.without_colors, "red", "red"),
        (L.category, "car door", "vehicle"),
        (L.is_structural, "blue rectangular bar", True),
    ],
)
def test_texts(spark, function, text, want):
    assert one(spark, function, text) == want


@pytest.mark.parametrize(
    ("gold", "said", "partial"),
    [("ge,pepco&", "ge,pepco& other corporations yes", True), ("valley troublesome rd", "troublesome rd", True), ("en", "en cada", True), ("highland", "glenfarclas", False), ("extralite", "extra lite", True), ("railhawk", "railhawks", True), ("]", "x", False)],
)
def test_partly_read(spark, gold, said, partial):
    assert one(spark, S.partly_read, gold, said) is partial


def test_f1(spark):
    assert one(spark, S.content_f1, "on the sign in the upper-left area of the image", "stop sign") == 0.5
    assert one(spark, S.content_f1, "on the sign wall near the top of the image", "on the top tube of the bicycle frame") < 0.5
    assert one(spark, S.word_f1, "a a b", "a b b") == pytest.approx(2 / 3)
    assert one(spark, S.word_f1, "", "a") == 0


def test_distinct_questions(spark):
    df = spark.createDataFrame([(["what does it say", "what does it say now"],), (["a b", "c d"],), (["a"],), ([],)], "q array<string>")
    assert [r.x for r in df.select(S.all_distinct(F.col("q")).alias("x")).collect()] == [False, True, True, True]


def test_payloads(spark):
    cases = {
        '```json\n[{"bbox_2d": [1,2,3,4], "label": "a"}, {"bbox_2d": [5,6,7,8], "label": "b"}]\n```': 2,
        'so: {"bbox_2d": [1,2,3,4], "label": "x"}': 1,
        '[{"bbox_2d": [1,2,3,4], "label": "x"}, {"bbox_2d": [1,2': 1,
        "nothing": 0,
    }
    for text, n in cases.items():
        assert len(one(spark, P.salvaged_boxes, text)) == n
    assert tuple(one(spark, P.ambiguity_reply, '{"ambiguous": true, "confidence": 0.75}'))[:2] == (True, 0.75)
    assert tuple(one(spark, P.ambiguity_reply, "```\n{\"ambiguous\": false}\n```"))[:2] == (False, 1.0)
    assert one(spark, P.ambiguity_reply, "no idea what").ambiguous is False
    assert one(spark, P.ambiguity_reply, "maybe").parse_ok is False


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_geometry(spark):
    a, b = Box.of(box(0, 0, 10, 10)), Box.of(box(5, 0, 15, 10))
    w, h = F.lit(640), F.lit(480)
    assert value(spark, G.iou(a, b)) == pytest.approx(1 / 3)
    assert value(spark, G.overlap(a, b)) == 0.5
    assert value(spark, G.iou(a, Box.of(box(20, 20, 30, 30)))) == 0
    assert [value(spark, G.region(Box.of(box(*s)), F.lit(90), F.lit(90))) for s in ((0, 0, 10, 10), (40, 40, 50, 50), (80, 80, 85, 85))] == ["ul", "cc", "lr"]
    assert value(spark, G.resolvability(box(0, 0, 120, 60), F.lit(224), F.lit(224))).passes is True
    assert value(spark, G.resolvability(box(0, 0, 20, 10), F.lit(224), F.lit(224))).passes is False
    text = Box.of(box(10, 10, 40, 30))
    assert value(spark, G.relation(text, Box.of(box(0, 0, 80, 60)), w, h)) == "on"
    assert value(spark, G.relation(text, Box.of(box(10, 80, 50, 140)), w, h)) == "above"
    assert value(spark, G.relation(Box.of(box(120, 10, 160, 40)), Box.of(box(20, 10, 80, 40)), w, h)) == "right_of"
    assert value(spark, G.relation(text, Box.of(box(500, 400, 520, 410)), w, h)) is None
    scaled = value(spark, G.from_thousandths(F.array(*map(F.lit, (100.0, 250.0, 900.0, 750.0))), F.lit(200), F.lit(100)))
    assert tuple(scaled) == (20, 25, 180, 75)


def test_bins(spark):
    df = spark.createDataFrame([(5,), (6,), (14,), (15,), (None,)], "n int")
    assert [r.x for r in df.select(B.density(F.col("n")).alias("x")).collect()] == ["low", "medium", "medium", "high", None]
