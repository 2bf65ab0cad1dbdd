"""Stemming as SQL of the checking engine, rule after rule over a table of terms."""

from __future__ import annotations

from ..functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4


def _shape(word: str) -> str:
    marked = f"regexp_replace(regexp_replace(regexp_replace({word}, '[^aeiouy]', '0', 'g'), '[aeiou]', '1', 'g'), '^y', '0')"
    folded = "acc || CASE WHEN c = 'y' THEN CASE WHEN right(acc, 1) = '0' THEN '1' ELSE '0' END ELSE c END"
    return f"list_reduce(list_prepend('', string_split({marked}, '')), lambda acc, c: {folded})"


def _steps(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, '10', ''))) // 2)"


def _less(word: str, letters: int) -> str:
    return f"left({word}, length({word}) - {letters})"


def _short(word: str, shape: str) -> str:
    return f"({shape} = '10' OR ({shape} LIKE '%010' AND right({word}, 1) NOT IN ('w', 'x', 'y')))"


def _suffix(word: str, suffixes: list[str]) -> str:
    return f"regexp_extract({word}, '({'|'.join(suffixes)})$', 1)"


def _case(column: str, rules: list[list[str]]) -> str:
    return f"CASE {column} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in rules)} END"


def _replaced(name: str, before: str, rules: list[list[str]]) -> str:
    measured = _steps(_shape("rest || CASE WHEN sfx = 'logi' THEN 'l' ELSE '' END"))
    return f"""
    {name}_cut AS (SELECT *, {_suffix('w', [a for a, _ in rules])} AS sfx, left(w, length(w) - length(sfx)) AS rest FROM {before}),
    {name} AS (SELECT term, CASE WHEN sfx <> '' AND {measured} > 0 THEN rest || {_case('sfx', rules)} ELSE w END AS w FROM {name}_cut)"""


def stems(terms: str) -> str:
    """CTEs from `terms` (term, distinct) to `stems` (term, stem)."""
    vowel = lambda word: f"contains({_shape(word)}, '1')"
    measure = lambda word: _steps(_shape(word))
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    mended = f"""CASE WHEN rest LIKE '%at' OR rest LIKE '%bl' OR rest LIKE '%iz' THEN rest || 'e'
      WHEN length(rest) > 1 AND right(rest, 1) = left(right(rest, 2), 1) AND right(shape, 1) = '0'
        THEN CASE WHEN right(rest, 1) IN ('l', 's', 'z') THEN rest ELSE {_less('rest', 1)} END
      WHEN {_steps('shape')} = 1 AND {_short('rest', 'shape')} THEN rest || 'e' ELSE rest END"""
    return f"""
    lowered AS (SELECT term, lower(term) AS w FROM {terms}),
    kept AS (SELECT term, CASE w {irregular} ELSE w END AS stem FROM lowered WHERE length(w) <= 2 OR w IN ({', '.join(f"'{w}'" for w in IRREGULAR)})),
    rule1 AS (SELECT term, CASE WHEN w LIKE '%sses' OR (w LIKE '%ies' AND length(w) > 4) THEN {_less('w', 2)}
      WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {_less('w', 1)} ELSE w END AS w FROM lowered WHERE term NOT IN (SELECT term FROM kept)),
    ended AS (SELECT term, w, CASE WHEN w LIKE '%ed' AND {vowel(_less('w', 2))} THEN {_less('w', 2)}
      WHEN w LIKE '%ing' AND {vowel(_less('w', 3))} THEN {_less('w', 3)} END AS rest FROM rule1),
    shaped AS (SELECT *, {_shape('rest')} AS shape FROM ended),
    rule2 AS (SELECT term, CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {_less('w', 1)} ELSE {_less('w', 2)} END
      WHEN w LIKE '%eed' THEN CASE WHEN {measure(_less('w', 3))} > 0 THEN {_less('w', 1)} ELSE w END
      WHEN rest IS NULL THEN w ELSE {mended} END AS w FROM shaped),
    rule3 AS (SELECT term, CASE WHEN w LIKE '%y' AND length(w) > 2 AND right({_shape(_less('w', 1))}, 1) = '0'
      THEN {_less('w', 1)} || 'i' ELSE w END AS w FROM rule2),
    rule4 AS (SELECT term, CASE WHEN w LIKE '%alli' AND {measure(_less('w', 4))} > 0 THEN {_less('w', 2)} ELSE w END AS w FROM rule3),
    {_replaced('rule5', 'rule4', STEP_2)},
    {_replaced('rule6', 'rule5', STEP_3)},
    rule7_cut AS (SELECT *, {_suffix('w', list(STEP_4))} AS sfx, left(w, length(w) - length(sfx)) AS rest FROM rule6),
    rule7 AS (SELECT term, CASE WHEN sfx <> '' AND (sfx <> 'ion' OR right(rest, 1) IN ('s', 't')) AND {measure('rest')} > 1
      THEN rest ELSE w END AS w FROM rule7_cut),
    rule8_cut AS (SELECT *, {_less('w', 1)} AS rest, {_shape(_less('w', 1))} AS shape FROM rule7),
    rule8 AS (SELECT term, CASE WHEN w LIKE '%e' AND ({_steps('shape')} > 1 OR ({_steps('shape')} = 1 AND NOT {_short('rest', 'shape')}))
      THEN rest ELSE w END AS w FROM rule8_cut),
    stems AS (SELECT term, CASE WHEN w LIKE '%ll' AND {measure(_less('w', 1))} > 1 THEN {_less('w', 1)} ELSE w END AS stem FROM rule8
      UNION ALL SELECT term, stem FROM kept)"""
