"""The stemmer of ROUGE-L as SQL: one CTE for each step over the distinct words."""

from __future__ import annotations

from collections.abc import Sequence

from ticketloom.functions.porter import IRREGULAR, STEP_2, STEP_3, STEP_4


def _shape(x: str) -> str:
    """c or v for each letter; each pass settles the next y of a row of them, and six are settled."""
    out = f"regexp_replace(regexp_replace(regexp_replace({x}, '[^aeiouy]', 'c', 'g'), '[aeiou]', 'v', 'g'), '^y', 'c')"
    for _ in range(3):
        out = f"regexp_replace(regexp_replace({out}, 'cy', 'cv', 'g'), 'vy', 'vc', 'g')"
    return out


def _cut(n: int, of: str = "x") -> str:
    return f"left({of}, len({of}) - {n})"


def _measure(shape: str) -> str:
    return f"len(regexp_extract_all({shape}, 'v+c+'))"


def _short(word: str, shape: str) -> str:
    return f"((ends_with({shape}, 'cvc') AND right({word}, 1) NOT IN ('w', 'x', 'y')) OR {shape} = 'vc')"


def _cases(rules: Sequence[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in rules) + " ELSE x END"


def _when(condition: str, then: str) -> str:
    return f"CASE WHEN {condition} THEN {then} ELSE x END"


def _table(pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(f"ends_with(x, '{old}')", _when(f"{_measure(_cut(len(old), 's'))} > 0", f"{_cut(len(old))} || '{new}'")) for old, new in pairs]


def stems(words: str) -> str:
    """CTEs from ``words (w)`` to ``stems (w, x)``; words of up to three letters stay."""
    plural = _cases([
        ("ends_with(x, 'sses')", _cut(2)),
        ("ends_with(x, 'ies')", f"CASE WHEN len(x) = 4 THEN {_cut(1)} ELSE {_cut(2)} END"),
        ("ends_with(x, 's') AND NOT ends_with(x, 'ss')", _cut(1)),
    ])
    # b is what is left of a word in -ed or -ing that has a vowel before it, t its shape.
    base = "CASE WHEN ends_with(x, 'ied') OR ends_with(x, 'eed') THEN NULL " + " ".join(
        f"WHEN ends_with(x, '{end}') AND contains({_cut(len(end), 's')}, 'v') THEN {_cut(len(end))}" for end in ("ed", "ing")
    ) + " END"
    past = _cases([
        ("ends_with(x, 'ied')", f"CASE WHEN len(x) = 4 THEN {_cut(1)} ELSE {_cut(2)} END"),
        ("ends_with(x, 'eed')", _when(f"{_measure(_cut(3, 's'))} > 0", _cut(1))),
        ("b IS NULL", "x"),
        ("right(b, 2) IN ('at', 'bl', 'iz')", "b || 'e'"),
        ("len(b) >= 2 AND b[-1] = b[-2] AND t[-1] = 'c'", f"CASE WHEN b[-1] IN ('l', 's', 'z') THEN b ELSE {_cut(1, 'b')} END"),
        (f"{_measure('t')} = 1 AND {_short('b', 't')}", "b || 'e'"),
        ("true", "b"),
    ])
    rest = [
        _when("ends_with(x, 'y') AND len(x) > 2 AND s[-2] = 'c'", f"{_cut(1)} || 'i'"),
        _when(f"ends_with(x, 'alli') AND {_measure(_cut(4, 's'))} > 0", _cut(2)),
        _cases([("ends_with(x, 'logi')", _when(f"{_measure(_cut(3, 's'))} > 0", _cut(1))), *_table(STEP_2)]),
        _cases(_table(STEP_3)),
        _cases([
            (f"ends_with(x, '{end}')", _when(f"{_measure(_cut(len(end), 's'))} > 1" + (f" AND right({_cut(3)}, 1) IN ('s', 't')" if end == "ion" else ""), _cut(len(end))))
            for end in STEP_4
        ]),
        _when(f"ends_with(x, 'e') AND ({_measure(_cut(1, 's'))} > 1 OR ({_measure(_cut(1, 's'))} = 1 AND NOT {_short(_cut(1), _cut(1, 's'))}))", _cut(1)),
        _when(f"ends_with(x, 'll') AND {_measure(_cut(1, 's'))} > 1", _cut(1)),
    ]
    irregular = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in IRREGULAR.items())
    out = [
        f"st0 AS (SELECT w, {plural} AS x FROM (SELECT w, w AS x FROM {words} WHERE len(w) > 3))",
        f"st1 AS (SELECT w, x, s, {base} AS b FROM (SELECT w, x, {_shape('x')} AS s FROM st0))",
        f"st2 AS (SELECT w, {past} AS x FROM (SELECT *, left(s, len(b)) AS t FROM st1))",
    ]
    for k, step in enumerate(rest, 3):
        out.append(f"st{k} AS (SELECT w, {step} AS x FROM (SELECT w, x, {_shape('x')} AS s FROM st{k - 1}))")
    last = f"st{len(rest) + 2}"
    out.append(f"stems AS (SELECT w, CASE w {irregular} ELSE x END AS x FROM {last} UNION ALL SELECT w, w FROM {words} WHERE len(w) <= 3)")
    return ",\n".join(out)
