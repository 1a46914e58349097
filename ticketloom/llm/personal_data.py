"""Personal data by bootstrapped contextual extraction, in DataFrame operations alone.

Seeds are the spans of four plain patterns (email, ip, card, phone).  The one or two words before a
seed are a lexical pattern for its kind.  Patterns and the values found behind them form a graph:
a pattern is as sure as the share of its distinct values that are known to be of its kind.  In each round
the values that sure patterns mark become known, and all patterns, new ones among them, are scored again.
Patterns that end up sure mark the identifier-like tokens behind them (five digits or more, or an ``@``) that no
plain pattern took and that have the form of the kind.

Java looks for each pattern from the left; possessive loops and looks behind keep it linear on long
runs and change no match.  Positions count code points.

A null or empty text has no spans.  Rows may repeat and share ids: each is scanned alone and gives
one row.  A value counts once for a pattern, however many copies of a document repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.tables import materialize

KINDS = ["email", "ip", "card", "phone"]
# The four patterns, leftmost and not overlapping.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Whole chains of 13 to 19 digits; no shorter or longer chain could pass.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
CANDIDATE = r"(?<!\S)(?=[^\s@]*+@|[^\s0-9]*+(?:[0-9][^\s0-9]*+){5})\S++"
SPAN = "array<struct<begin:int,end:int,value:string,near:string,far:string>>"
ROUNDS, MIN_SEEDS, MIN_CONFIDENCE = 3, 3, 0.8


def _context(gap: Column) -> tuple[Column, Column]:
    """The last word before a match, and the last two; empty if none is set off by white space."""
    tail = F.lower(F.right(gap, F.lit(60)))
    near, far = F.regexp_extract(tail, r"(\S+)\s+$", 1), F.regexp_extract(tail, r"(\S+\s+\S+)\s+$", 1)
    return near, F.regexp_replace(far, r"\s+", " ")


def _located(text: Column, pattern: str, keep) -> Column:
    """The matches that ``keep`` accepts, with their places and the words before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, e: Column) -> Column:
        begin = acc.at + F.length(e.gap)
        end = begin + F.length(e.match)
        near, far = _context(e.gap)
        span = F.array(F.struct(begin.alias("begin"), end.alias("end"), e.match.alias("value"), near.alias("near"), far.alias("far")))
        return F.struct(end.alias("at"), F.when(keep(e.match), F.concat(acc.out, span)).otherwise(acc.out).alias("out"))

    pairs = F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    # What stands behind the last match has no match.
    return F.aggregate(F.filter(pairs, lambda e: e.match.isNotNull()), zero, step, lambda acc: acc.out)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether every second digit from the right doubled, less nine if over nine, gives a sum divisible by ten."""
    figures = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: F.coalesce(F.try_to_number(d, F.lit("9")), F.lit(0)).cast("int"))
    weighed = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def _small_parts(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


KEEP = {
    "email": lambda v: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def scan(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``row, doc_id``, the spans of each kind, and the identifier-like tokens; written once.

    Texts are left out unless ``whole`` asks for the rows themselves, as ``doc``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast(SPAN)
    columns = {}
    for kind in KINDS:
        needed = F.contains(text, F.lit(NEEDED[kind])) if kind in NEEDED else F.lit(True)
        columns[kind] = F.when(needed & text.rlike(PATTERNS[kind]), _located(text, PATTERNS[kind], KEEP[kind])).otherwise(none)
    columns["others"] = F.when(text.rlike(CANDIDATE), _located(text, CANDIDATE, lambda v: F.lit(True))).otherwise(none)
    kept = F.struct(*docs.columns).alias("doc") if whole else F.col("doc_id").cast("long").alias("doc_id")
    return materialize(docs.select(F.monotonically_increasing_id().alias("row"), kept, *(c.alias(k) for k, c in columns.items())), "personal-scan")


def _free(scanned: DataFrame) -> DataFrame:
    """``row, begin, end, value, near, far`` of identifier-like tokens, edge marks trimmed, that touch no seed."""
    taken = F.concat(*KINDS)
    each = scanned.where(F.size("others") > 0).select("row", taken.alias("taken"), F.explode("others").alias("o"))
    head = F.regexp_extract("o.value", r"^[^\p{L}\p{N}@+]*", 0)
    core = F.regexp_replace(F.expr("substring(o.value, length(head) + 1)"), r"[^\p{L}\p{N}]+$", "")
    each = each.withColumn("head", head).withColumn("value", core)
    begin = F.col("o.begin") + F.length("head")
    each = each.select("row", "taken", begin.alias("begin"), (begin + F.length("value")).alias("end"), "value", F.col("o.near").alias("near"), F.col("o.far").alias("far"))
    return each.where((F.col("value") != "") & ~F.exists("taken", lambda s: (s.begin < F.col("end")) & (s.end > F.col("begin")))).drop("taken")


def _edges(spans: DataFrame, *columns: str) -> DataFrame:
    """One row for each pattern and value, for both lengths of context."""
    patterns = F.explode(F.filter(F.array("near", "far"), lambda c: c != "")).alias("pattern")
    return spans.select(*columns, F.sha2(F.lower("value"), 256).alias("value"), patterns).distinct()


def _forms(value: str) -> Column:
    """The kinds whose form an identifier-like token may have: an ``@``, or enough digits or parts."""
    digits = F.length(_digits(F.col(value)))
    may = {"email": F.contains(F.col(value), F.lit("@")), "ip": F.size(F.split(value, r"[.:]")) >= 4, "card": digits >= 12, "phone": digits.between(7, 15)}
    return F.array_compact(F.array(*[F.when(may[k], F.lit(k)) for k in KINDS]))


def _family(pattern: str) -> Column:
    """Patterns of one place, one word and two, share their last word: they are no independent witnesses."""
    return F.substring_index(pattern, " ", -1)


def pattern_scores(scanned: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pattern, kind, known, confidence`` of every pattern with ``min_seeds`` known values or more, after the last round.

    A round takes in the values that sure patterns mark, and counts every pattern's known values anew: those
    new ones bring support to the other contexts they stand in.  A value found through a pattern's own
    family does not support it.  Every step aggregates by pattern or by value before it joins; rows stay edges
    of the graph.
    """
    seeds = None
    for kind in KINDS:
        one = scanned.where(F.size(kind) > 0).select(F.lit(kind).alias("kind"), F.inline(kind))
        seeds = one if seeds is None else seeds.unionByName(one)
    known = materialize(_edges(seeds, "kind"), "seed-edges")
    free = materialize(_edges(_free(scanned).withColumn("kinds", _forms("value")), "kinds"), "free-edges")
    sizes = known.groupBy("pattern").agg(F.count_distinct("value").alias("n")).unionByName(free.groupBy("pattern").agg(F.count_distinct("value").alias("n")))
    sizes = materialize(sizes.groupBy("pattern").agg(F.sum("n").alias("values")), "pattern-sizes")
    seeded = materialize(known.groupBy("pattern", "kind").agg(F.count("*").alias("seeds")), "pattern-seeds")
    scored = None
    for _ in range(max(1, rounds)):
        if scored is None:
            support = seeded.withColumnRenamed("seeds", "known")
        else:
            sure = scored.where(F.col("confidence") >= min_confidence).select("pattern", "kind", _family("pattern").alias("family"))
            found = free.join(sure, "pattern").where(F.array_contains("kinds", F.col("kind"))).groupBy("value", "kind").agg(F.min("family").alias("one"), F.max("family").alias("other"))
            own = _family("pattern")
            gained = free.join(found, "value").where(F.array_contains("kinds", F.col("kind")) & ((F.col("one") != own) | (F.col("other") != own)))
            gained = gained.groupBy("pattern", "kind").agg(F.count_distinct("value").alias("gained"))
            support = seeded.join(gained, ["pattern", "kind"], "full").select("pattern", "kind", (F.coalesce("seeds", F.lit(0)) + F.coalesce("gained", F.lit(0))).alias("known"))
        rated = support.where(F.col("known") >= min_seeds).join(sizes, "pattern")
        scored = materialize(rated.select("pattern", "kind", "known", (F.col("known") / F.col("values")).alias("confidence")), "pattern-scores")
    return scored


def sure_patterns(scanned: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pattern, kind, confidence`` of the patterns that end up sure."""
    scored = pattern_scores(scanned, rounds, min_seeds, min_confidence)
    return scored.where(F.col("confidence") >= min_confidence).select("pattern", "kind", "confidence")


def discovered(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """``row`` and the spans that sure patterns add, each under its surest kind among those it has the form of."""
    free = _free(scanned).select("row", "begin", "end", _forms("value").alias("kinds"), F.explode(F.filter(F.array("near", "far"), lambda c: c != "")).alias("pattern"))
    marked = free.join(patterns, "pattern").where(F.array_contains("kinds", F.col("kind")))
    best = marked.groupBy("row", "begin", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    return best.groupBy("row").agg(F.collect_list(F.struct("kind", "begin", "end")).alias("added"))


def find(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, the seeds of each kind, and ``added`` spans (kind, begin, end) of every document."""
    scanned = scan(docs)
    added = discovered(scanned, sure_patterns(scanned, **options))
    return scanned.drop("others").join(added, "row", "left").drop("row")


def _named(kind: str) -> Column:
    """The seeds of a kind as (begin, end, kind)."""
    return F.transform(kind, lambda s: F.struct(s.begin.alias("begin"), s.end.alias("end"), F.lit(kind).alias("kind")))


def _added() -> Column:
    spans = F.transform("added", lambda s: F.struct(s.begin.alias("begin"), s.end.alias("end"), s.kind.alias("kind")))
    return F.coalesce(spans, F.array().cast("array<struct<begin:int,end:int,kind:string>>"))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s.kind == kind)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.begin.cast("string"), s.end.cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of what :func:`find` gives."""
    ordered = [F.array_sort(F.concat(_named(k), _of_kind(_added(), k))) for k in KINDS]
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(F.concat(*map(_named, KINDS))), 256).alias("base_sha256"), _listed(F.concat(*ordered)).alias("spans"),
    )


def masked(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with each span replaced by its kind in brackets; all columns kept.

    Of spans that overlap, the first hides the rest.  Rows are written once beside their spans; only the
    added spans, a table of a known size, are joined to them.
    """
    scanned = scan(docs, whole=True)
    added = materialize(discovered(scanned, sure_patterns(scanned, **options)), "added-spans")
    every = F.concat(*map(_named, KINDS), _added())
    rows = scanned.join(added, "row", "left").select("doc", F.array_sort(every).alias("spans"))
    text = F.col("doc.text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        shown = F.concat(acc.out, F.substring(text, acc.at + 1, s.begin - acc.at), F.lit("["), s.kind, F.lit("]"))
        return F.when(s.begin >= acc.at, F.struct(s.end.alias("at"), shown.alias("out"))).otherwise(F.struct(F.greatest(acc.at, s.end).alias("at"), acc.out.alias("out")))

    hidden = F.aggregate("spans", zero, step, lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))))
    return rows.select(*(F.when(F.size("spans") > 0, hidden).otherwise(text).alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns))
