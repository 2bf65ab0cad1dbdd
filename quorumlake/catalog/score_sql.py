"""The fuzzy scores as SQL of the checking engine.

The common subsequence is folded over masks of 120 places, as the engine has
128-bit integers. Each function gives an expression, or a CTE list, as text.
"""

from __future__ import annotations

_FULL = "((1::HUGEINT << 120) - 1)"


def common(a: str, b: str) -> str:
    """Length of the longest common subsequence of two text columns."""
    blocks = f"CEIL(LENGTH({a}) / 120)::INT"
    masks = (
        f"[LIST_SUM([CASE WHEN SUBSTR({a}, k * 120 + i + 1, 1) = ch THEN 1::HUGEINT << i ELSE 0::HUGEINT END "
        f"FOR i IN RANGE(LEAST(120, LENGTH({a}) - k * 120))])::HUGEINT FOR k IN RANGE({blocks})]"
    )
    empty = "[]::HUGEINT[]"
    added = "(x.v + (x.v & x.m) + acc.c)"
    step = (
        f"LIST_REDUCE(LIST_PREPEND({{'c': 0::HUGEINT, 'o': {empty}, 'v': 0::HUGEINT, 'm': 0::HUGEINT}}, "
        f"[{{'c': 0::HUGEINT, 'o': {empty}, 'v': s.v[j], 'm': e.m[j]}} FOR j IN RANGE(1, LEN(s.v) + 1)]), "
        f"LAMBDA acc, x: {{'c': {added} >> 120, 'o': LIST_APPEND(acc.o, ({added} | (x.v - (x.v & x.m))) & {_FULL}), "
        f"'v': 0::HUGEINT, 'm': 0::HUGEINT}}).o"
    )
    folded = (
        f"LIST_REDUCE(LIST_PREPEND({{'v': [{_FULL} FOR z IN RANGE({blocks})], 'm': {empty}}}, "
        f"[{{'v': {empty}, 'm': {masks}}} FOR ch IN STRING_SPLIT({b}, '')]), "
        f"LAMBDA s, e: {{'v': {step}, 'm': e.m}}).v"
    )
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE 120 * {blocks} - LIST_SUM([BIT_COUNT(v) FOR v IN {folded}]) END"


def _percent(distance: str, total: str) -> str:
    return f"(CASE WHEN {total} = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE - 100.0::DOUBLE * ({distance}) / ({total}) END)"


def plain(text: str) -> str:
    return f"TRIM(REGEXP_REPLACE(LOWER(COALESCE({text}, '')), '[^\\p{{L}}\\p{{N}}]', ' ', 'g'))"


def words(text: str) -> str:
    return f"LIST_FILTER(STRING_SPLIT({text}, ' '), LAMBDA w: w <> '')"


def token_sets(pairs: str) -> str:
    """CTEs from `pairs` (a, b: two texts) to `token_sets` (a, b, token_set)."""
    joined = lambda kept: f"ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT({kept})), ' ')"
    gap = "(shared > 0)::INT"
    return f"""
    texts AS (SELECT DISTINCT a, b, {plain('a')} AS pa, {plain('b')} AS pb FROM {pairs}),
    worded AS (SELECT *, {words('pa')} AS wa, {words('pb')} AS wb FROM texts),
    parted AS (SELECT *, {joined('LIST_FILTER(wa, LAMBDA w: LIST_CONTAINS(wb, w))')} AS both_words,
      {joined('LIST_FILTER(wa, LAMBDA w: NOT LIST_CONTAINS(wb, w))')} AS xa, {joined('LIST_FILTER(wb, LAMBDA w: NOT LIST_CONTAINS(wa, w))')} AS xb FROM worded),
    measured AS (SELECT *, LENGTH(both_words) AS shared, LENGTH(xa) AS sa, LENGTH(xb) AS sb, {common('xa', 'xb')} AS n FROM parted),
    rated AS (SELECT *, {_percent('sa + sb - 2 * n', f'2 * (shared + {gap}) + sa + sb')} AS apart FROM measured),
    token_sets AS (SELECT *, CASE WHEN shared > 0 AND (sa = 0 OR sb = 0) THEN 100.0::DOUBLE
      WHEN shared > 0 THEN GREATEST(apart, {_percent(f'{gap} + sa', f'2 * shared + {gap} + sa')}, {_percent(f'{gap} + sb', f'2 * shared + {gap} + sb')})
      ELSE apart END AS sets, CASE WHEN pa = '' OR pb = '' THEN 0.0::DOUBLE ELSE sets END AS token_set FROM rated)"""


def _ratio(a: str, b: str) -> str:
    return _percent(f"LENGTH({a}) + LENGTH({b}) - 2 * ({common(a, b)})", f"LENGTH({a}) + LENGTH({b})")


def names(pairs: str) -> str:
    """CTEs from `pairs` (a, b: two texts) to `names` (a, b, name_score)."""
    windows = (
        "SELECT kind, less, more, UNNEST([SUBSTR(more, GREATEST(p, 0) + 1, LEAST(p, 0) + LENGTH(less)) FOR p IN RANGE(1 - LENGTH(less), LENGTH(more))]) AS part "
        "FROM sides"
    )
    side = lambda kind, a, b: (
        f"SELECT DISTINCT '{kind}' AS kind, CASE WHEN LENGTH({a}) > LENGTH({b}) THEN {b} ELSE {a} END AS less, "
        f"CASE WHEN LENGTH({a}) > LENGTH({b}) THEN {a} ELSE {b} END AS more FROM ordered"
    )
    part = lambda kind, a, b: (
        f"COALESCE((SELECT MAX(r.score) FROM parts_best r WHERE r.kind = '{kind}' "
        f"AND r.less = CASE WHEN LENGTH({a}) > LENGTH({b}) THEN {b} ELSE {a} END AND r.more = CASE WHEN LENGTH({a}) > LENGTH({b}) THEN {a} ELSE {b} END), 0.0)"
    )
    ordered = lambda w: f"ARRAY_TO_STRING(LIST_SORT({w}), ' ')"
    return f"""{token_sets(pairs)},
    ordered AS (SELECT *, {ordered('wa')} AS oa, {ordered('wb')} AS ob FROM token_sets WHERE pa <> '' AND pb <> ''),
    sides AS ({side('text', 'pa', 'pb')} UNION {side('order', 'oa', 'ob')} UNION {side('only', 'xa', 'xb')}),
    windowed AS (SELECT DISTINCT * FROM ({windows}) WHERE less <> ''),
    parts_best AS (SELECT kind, less, more, MAX({_ratio('less', 'part')}) AS score FROM windowed GROUP BY ALL),
    whole AS (SELECT *, {_ratio('pa', 'pb')} AS whole, {_ratio('oa', 'ob')} AS sorted_ratio,
      GREATEST(LENGTH(pa), LENGTH(pb)) / LEAST(LENGTH(pa), LENGTH(pb)) AS spread,
      {part('text', 'pa', 'pb')} AS p_text, {part('order', 'oa', 'ob')} AS p_order,
      CASE WHEN shared > 0 THEN 100.0 ELSE {part('only', 'xa', 'xb')} END AS p_only FROM ordered),
    names AS (SELECT a, b, CASE WHEN spread < 1.5 THEN GREATEST(whole, 0.95::DOUBLE * sorted_ratio, 0.95::DOUBLE * sets)
      ELSE GREATEST(whole, CASE WHEN spread <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END * p_text,
        CASE WHEN spread <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END * 0.95::DOUBLE * GREATEST(p_order, p_only)) END AS name_score FROM whole)"""
