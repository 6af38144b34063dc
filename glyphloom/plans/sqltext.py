"""SQL expressions for the same values that the column functions compute, for checking them."""

from __future__ import annotations

from glyphloom.functions.normalize import ADDRESS, ARTICLES, NUMBER_WORDS

SPACE = r"[\s\p{Z}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(map(q, words)) + "]"


def text(x: str) -> str:
    return f"coalesce({x}, '')"


def strip(x: str) -> str:
    return f"regexp_replace({text(x)}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def spaced(x: str) -> str:
    return f"regexp_replace(lower({strip(x)}), '{SPACE}+', ' ', 'g')"


def plain(x: str) -> str:
    return strip(rf"regexp_replace({spaced(x)}, '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', '', 'g')")


def tokens(x: str) -> str:
    return rf"regexp_extract_all({text(x)}, '[^\s\p{{Z}}]+')"


def vqa(x: str) -> str:
    numbers = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in NUMBER_WORDS.items()) + "}"
    words = tokens(rf"regexp_replace(lower({text(x)}), '[^\p{{L}}\p{{N}}_\s\p{{Z}}'']', ' ', 'g')")
    return f"array_to_string([coalesce({numbers}[w], w) FOR w IN {words} IF coalesce({numbers}[w], w) NOT IN ({', '.join(map(q, ARTICLES))})], ' ')"


def text_answer(x: str) -> str:
    return spaced(f"translate({text(x)}, '’‘“”', '''''\"\"')")


def by_type(x: str, kind: str) -> str:
    return f"CASE WHEN lower({strip(kind)}) IN ('yes', 'no', 'number') THEN {vqa(x)} ELSE {text_answer(x)} END"


def compact(x: str) -> str:
    return rf"regexp_replace({text(x)}, '[^\p{{L}}\p{{N}}]', '', 'g')"


def valid(x: str) -> str:
    t = strip(x)
    c = compact(t)
    one = f"len(list_distinct(string_split(lower({c}), ''))) = 1"
    return f"(length({t}) BETWEEN 2 AND 32 AND len({tokens(t)}) <= 6 AND NOT (length({c}) >= 4 AND (regexp_full_match({c}, '(?i)[1il|]+') OR {one})) AND regexp_matches({t}, '[A-Za-z0-9]'))"


def blocked(x: str) -> str:
    t = strip(x)
    return rf"({t} = '' OR regexp_matches({t}, {q(ADDRESS)}) OR (length(regexp_replace({t}, '\P{{Nd}}', '', 'g')) >= 7 AND regexp_matches({t}, '[-()]')))"


def case_tag(x: str) -> str:
    t = rf"regexp_replace({text(x)}, '{SPACE}+', '', 'g')"
    return rf"CASE WHEN regexp_full_match({t}, '\p{{Nd}}+') THEN 'numeric' WHEN regexp_full_match({t}, '[\p{{L}}\p{{N}}]+') AND NOT regexp_full_match({t}, '\p{{L}}+') THEN 'alphanumeric' WHEN upper({t}) <> lower({t}) AND {t} = upper({t}) THEN 'upper' WHEN upper({t}) <> lower({t}) AND {t} = lower({t}) THEN 'lower' ELSE 'mixed' END"


def text_kind(x: str) -> str:
    c = compact(plain(x))
    return rf"CASE WHEN regexp_full_match({c}, '\p{{Nd}}+') THEN 'numeric' WHEN regexp_full_match({c}, '\p{{L}}+') THEN 'alpha' WHEN {c} <> '' THEN 'alnum' ELSE 'mixed' END"


# geometry


def width(b: str) -> str:
    return f"({b}.x2 - {b}.x1)"


def height(b: str) -> str:
    return f"({b}.y2 - {b}.y1)"


def area(b: str) -> str:
    return f"({width(b)} * {height(b)})"


def cx(b: str) -> str:
    return f"(({b}.x1 + {b}.x2) / 2)"


def cy(b: str) -> str:
    return f"(({b}.y1 + {b}.y2) / 2)"


def shared(a: str, b: str) -> str:
    return f"(greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0.0) * greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0.0))"


def overlap(a: str, b: str) -> str:
    return f"({shared(a, b)} / greatest({area(a)}, 1e-6))"


def iou(a: str, b: str) -> str:
    return f"(CASE WHEN {shared(a, b)} <= 0 THEN 0.0 ELSE {shared(a, b)} / greatest(greatest({area(a)}, 1e-6) + greatest({area(b)}, 1e-6) - {shared(a, b)}, 1e-6) END)"


def gap(a: str, b: str, axis: str) -> str:
    return f"greatest({b}.{axis}1 - {a}.{axis}2, {a}.{axis}1 - {b}.{axis}2, 0.0)"


def axis_overlap(a: str, b: str, axis: str) -> str:
    return f"(greatest(least({a}.{axis}2, {b}.{axis}2) - greatest({a}.{axis}1, {b}.{axis}1), 0.0) / greatest(least({a}.{axis}2 - {a}.{axis}1, {b}.{axis}2 - {b}.{axis}1), 1e-6))"


def distance(a: str, b: str) -> str:
    return f"sqrt(({cx(a)} - {cx(b)}) * ({cx(a)} - {cx(b)}) + ({cy(a)} - {cy(b)}) * ({cy(a)} - {cy(b)}))"


def relation(t: str, a: str, w: str, h: str) -> str:
    areas = f"greatest({area(t)}, 1e-6)", f"greatest({area(a)}, 1e-6)"
    stacked = f"{axis_overlap(t, a, 'x')} >= 0.2 AND {gap(t, a, 'y')} <= 0.2::DOUBLE * {h}"
    beside = f"{axis_overlap(t, a, 'y')} >= 0.2 AND {gap(t, a, 'x')} <= 0.3::DOUBLE * {w}"
    return f"""CASE WHEN {overlap(t, a)} >= 0.35 THEN 'on' WHEN greatest({', '.join(areas)}) / least({', '.join(areas)}) > 5 THEN NULL
        WHEN {stacked} AND {cy(t)} < {cy(a)} THEN 'above' WHEN {stacked} AND {cy(t)} > {cy(a)} THEN 'below'
        WHEN {beside} AND {cx(t)} < {cx(a)} THEN 'left_of' WHEN {beside} AND {cx(t)} > {cx(a)} THEN 'right_of' END"""


def relevance(t: str, a: str, x: str, y: str, w: str, h: str) -> str:
    t_area, a_area = f"greatest({area(t)}, 1.0)", f"greatest({area(a)}, 1.0)"
    dx, dy = f"greatest({a}.x1 - {x}, {x} - {a}.x2, 0.0)", f"greatest({a}.y1 - {y}, {y} - {a}.y2, 0.0)"
    near = f"greatest(1 - sqrt({dx} * {dx} + {dy} * {dy}) / greatest(greatest({w}, {h})::DOUBLE, 1.0), 0.0)"
    ratio, share = f"({a_area} / {t_area})", f"({a_area} / greatest({w}::DOUBLE * {h}, 1.0))"
    inside = f"({x} BETWEEN {a}.x1 AND {a}.x2 AND {y} BETWEEN {a}.y1 AND {a}.y2)"
    fit = f"(CASE WHEN {inside} AND {ratio} BETWEEN 1.5 AND 80 THEN 0.22 WHEN {inside} AND {ratio} <= 140 THEN 0.10 ELSE 0 END)::DOUBLE"
    large = f"(CASE WHEN {share} > 0.55 THEN least(0.85::DOUBLE, ({share} - 0.55) * 1.7) ELSE 0 END)"
    huge = f"(CASE WHEN {ratio} > 140 THEN least(0.75::DOUBLE, ln({ratio} / 140 + 1) * 0.45) ELSE 0 END)"
    return f"greatest({overlap(t, a)} * 0.32::DOUBLE + {shared(t, a)} / greatest({t_area} + {a_area} - {shared(t, a)}, 1.0) * 0.28::DOUBLE + {near} * 0.18::DOUBLE + {fit} - {large} - {huge}, 0.0)"


def connected(a: str, b: str, w: str, h: str) -> str:
    one = lambda v: f"greatest({v}, 1.0)"
    high = f"greatest({one(height(a))}, {one(height(b))})"
    span = f"greatest({one(width(a))}, {one(height(a))}, {one(width(b))}, {one(height(b))})"
    return f"""(greatest({overlap(a, b)}, {overlap(b, a)}) >= 0.05 OR ({axis_overlap(a, b, 'y')} >= 0.3 AND {gap(a, b, 'x')} <= 2.2::DOUBLE * {high})
        OR ({axis_overlap(a, b, 'x')} >= 0.3 AND {gap(a, b, 'y')} <= 2.2::DOUBLE * {high}) OR {distance(a, b)} <= greatest(40.0, greatest({w}, {h}) * 0.11::DOUBLE, {span} * 2.4::DOUBLE))"""


def supports(a: str, b: str) -> str:
    diagonal = lambda v: f"sqrt({width(v)} * {width(v)} + {height(v)} * {height(v)})"
    return f"(greatest({overlap(a, b)}, {overlap(b, a)}) >= 0.35 OR {distance(a, b)} <= 0.22::DOUBLE * greatest({diagonal(a)}, {diagonal(b)}, 1.0))"


def direction(a: str, b: str, w: str, h: str) -> str:
    dx, dy = f"({cx(b)} - {cx(a)})", f"({cy(b)} - {cy(a)})"
    across, down = f"CASE WHEN {dx} > 0 THEN 'right_of' ELSE 'left_of' END", f"CASE WHEN {dy} > 0 THEN 'below' ELSE 'above' END"
    return f"""CASE WHEN greatest({overlap(a, b)}, {overlap(b, a)}) > 0.05 THEN 'overlapping' WHEN abs({dx}) > abs({dy}) THEN {across} WHEN abs({dy}) > abs({dx}) THEN {down}
        WHEN abs({dx}) >= 0.05::DOUBLE * {w} THEN {across} WHEN abs({dy}) >= 0.05::DOUBLE * {h} THEN {down} ELSE 'overlapping' END"""


def region(b: str, w: str, h: str) -> str:
    third = lambda v, size, n: f"CASE WHEN {v} < {size} / 3 THEN '{n[0]}' WHEN {v} < 2 * {size} / 3 THEN '{n[1]}' ELSE '{n[2]}' END"
    return f"({third(cy(b), h, 'ucl')} || {third(cx(b), w, 'lcr')})"
