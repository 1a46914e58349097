"""Text expressions on columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The whitespace that `\s` means for Unicode text, spelled out for the Java engine.
UNICODE_SPACE = r"\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# The cleaning patterns.
HTML_TAG = r"<[^>]+>"
URL = rf"https?://[^{UNICODE_SPACE}]+|www\.[^{UNICODE_SPACE}]+"
EMAIL = rf"[^{UNICODE_SPACE}]+@[^{UNICODE_SPACE}]+\.[^{UNICODE_SPACE}]+"
NOT_ALNUM = r"[^a-z0-9]+"

# Code points that are their own NFKC form and never combine with a neighbour: ASCII, most of
# Latin-1 and Latin Extended-A, and the common dashes, quotes, bullet and euro sign.  A text made
# of these alone needs no normalisation.
NFKC_STABLE = (
    r"\x00-\x7f\u00a1-\u00a7\u00a9\u00ab-\u00ae\u00b0\u00b1\u00b6\u00b7\u00bb\u00bf-\u0131"
    r"\u0134-\u013e\u0141-\u0148\u014a-\u017e\u2013\u2014\u2018\u2019\u201c\u201d\u2022\u20ac"
)

# Words that appear in every queue and say nothing about any of them.
# Function words of English: they say nothing about a ticket, in whatever form they are written.
GENERAL_STOP_WORDS = (
    "a about above after again against all also although always am among an and another any are as at be because been before being below "
    "between both but by can could did do does doing done down during each either else ever every few for from further had has have having "
    "he her here hers herself him himself his how however if in into is it its itself just least less many may me might mine more most much "
    "must my myself neither never no nor not nothing now of off often on once only or other others our ours ourselves out over own perhaps "
    "quite rather really same several she should since so some such than that the their theirs them themselves then there therefore these "
    "they this those though through thus to too toward under until up upon us very was we well were what whatever when whenever where "
    "whether which while who whoever whole whom whose why will with within without would yet you your yours yourself yourselves"
).split()
DOMAIN_STOP_WORDS = [
    "the", "a", "an", "i", "my", "to", "for", "in", "is", "was", "am",
    "not", "this", "there", "be", "with", "on", "and", "of", "you", "we",
    "our", "your", "have", "would", "could", "please", "dear", "support",
    "team", "customer", "help", "issue", "ticket", "request", "problem",
    "contact", "hi", "hello", "thank", "thanks", "use", "get", "let", "know",
]

# The function words each language is recognised by.
LANGUAGE_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "den", "von", "zu", "mit", "sich", "auf", "für", "im", "dem", "des", "als", "auch"],
    "en": ["the", "and", "is", "of", "to", "in", "that", "it", "for", "was", "with", "are", "this", "have", "from", "by", "on", "at", "which"],
    "es": ["el", "los", "las", "y", "una", "por", "con", "para", "que", "se", "del", "su", "no", "al", "como", "más", "pero", "sus", "en"],
    "fr": ["le", "la", "les", "et", "est", "des", "du", "une", "dans", "que", "qui", "pour", "pas", "sur", "avec", "au", "aux", "ce", "un"],
}


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(text: Column) -> Column:
    """NFKC form.  Only texts holding a code point that could change are sent to Python.

    Equal byte and character counts settle plain ASCII; the class of stable code points is tried
    only behind a character outside ASCII.
    """
    suspect = text.rlike(rf"[^\x00-\x7f](?<![{NFKC_STABLE}])")
    unstable = F.when(F.octet_length(text) != F.length(text), F.when(suspect, text))
    return F.coalesce(_nfkc(unstable), text)


def clean_text(text: Column, strip_html: bool = False, normalize: bool = True) -> Column:
    """Normalised, lower-case, alphanumeric text without links and mail addresses; null stays null."""
    base = nfkc(text) if normalize else text
    # Most tickets hold neither tags, links nor mail addresses: a substring test spares them the
    # backtracking patterns.
    out = base
    if strip_html:
        out = F.when(base.contains("<"), F.regexp_replace(out, HTML_TAG, " ")).otherwise(out)
    out = F.when(base.contains("http") | base.contains("www."), F.regexp_replace(out, URL, " ")).otherwise(out)
    out = F.when(base.contains("@"), F.regexp_replace(out, EMAIL, " ")).otherwise(out)
    # One pass replaces runs of anything that is not a letter or digit, whitespace included, which
    # also collapses the spaces the earlier steps left behind.
    return F.trim(F.regexp_replace(F.lower(out), NOT_ALNUM, " "))


def whitespace_tokens(text: Column) -> Column:
    """Non-empty tokens between whitespace."""
    return F.filter(F.split(text, f"[{UNICODE_SPACE}]+"), lambda t: t != "")


def word_tokens(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w\w+)"), F.lit(1))


def alnum_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1))


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by every pair of neighbours, joined by a space."""
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(tokens, pairs)


def keep_terms(tokens: Column, stop_words: Sequence[str], min_chars: int = 3) -> Column:
    """Tokens of at least ``min_chars`` characters that are not stop words."""
    return F.filter(tokens, lambda t: (F.length(t) >= min_chars) & ~t.isin(list(stop_words)))


def prefix(text: Column, n: int = 100) -> Column:
    return F.substring(text, 1, n)


def token_count(text: Column, special: int = 2) -> Column:
    """Whitespace tokens plus the sequence markers a sentence encoder adds."""
    return F.size(whitespace_tokens(text)) + F.lit(special)


def text_digest(text: Column) -> Column:
    """32 bytes that stand for a whole text as a shuffle key; null for null."""
    return F.unhex(F.sha2(text, 256))


def row_digest(columns: Sequence[str], schema) -> Column:
    """32 bytes that stand for a whole row, null equal to null, with no two layouts colliding."""
    parts = []
    for name in columns:
        simple = schema[name].dataType.simpleString()
        value = F.to_json(F.struct(name)) if ("<" in simple) else F.col(name).cast("string")
        parts.append(
            F.when(F.col(name).isNull(), F.lit("-")).otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value))
        )
    return F.unhex(F.sha2(F.concat(*parts), 256))


def language_words(text: Column) -> Column:
    """The function words of any listed language in the text, in order."""
    known = sorted({w for words in LANGUAGE_WORDS.values() for w in words})
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1)), lambda t: t.isin(known))


def likeliest_language(words: Column) -> Column:
    """The language with most hits among ``language_words``, ties by code; ``unknown`` without any."""

    def hits(listed: Sequence[str]) -> Column:
        return F.size(F.filter(words, lambda t: t.isin(list(listed))))

    votes = [
        F.struct(hits(listed).alias("hits"), F.lit(rank).alias("order"), F.lit(lang).alias("lang"))
        for rank, (lang, listed) in enumerate(sorted(LANGUAGE_WORDS.items(), reverse=True))
    ]
    # size() of a missing text is -1 or null, so only a positive count names a language.
    nothing = F.struct(F.lit(0).alias("hits"), F.lit(len(votes)).alias("order"), F.lit("unknown").alias("lang"))
    return F.array_max(F.array(*votes, nothing))["lang"]


def metric_key(name: Column) -> Column:
    """Metric names as tracking keys: ``@`` is not allowed there."""
    return F.regexp_replace(name, "@", "_")
