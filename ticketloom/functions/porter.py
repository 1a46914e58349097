"""Porter's suffix-stripping stemmer (1980) with the usual library extensions, as a rule table."""

from __future__ import annotations

import functools
import re

# Words the rules would spoil.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Fixed values: (suffix, replacement) of the steps that ask for a stem of measure > 0.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
# Suffixes dropped from a stem of measure > 1.
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """c or v per letter; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _doubled(word: str) -> bool:
    return len(word) >= 2 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _by_table(word: str, table) -> str:
    for suffix, replacement in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + replacement if _measure(stem) > 0 else word
    return word


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _doubled(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return word


def _step_2(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _step_2(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _by_table(word, STEP_2)


def _step_4(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            allowed = _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t")))
            return stem if allowed else word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            return word[:-1]
    return word


@functools.lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    word = _final_e(_step_4(_by_table(_step_2(word), STEP_3)))
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word
