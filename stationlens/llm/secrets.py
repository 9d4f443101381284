"""Secret scans (3): patterns, and sliding-window entropy. DataFrame functions only.

Base kinds are leftmost non-overlapping matches of the patterns below, of which those
that are too short are dropped. To these the method adds spans of high entropy:
candidates are runs of the characters of a class; in each, Shannon entropy is taken
over windows of ``WINDOW`` characters. A step of the window takes one character out and
one in, so the sum of c log2 c is carried along and changed by these two counts.
Windows at or above the class's threshold are joined to spans. Suppressed are UUIDs,
windows that overlap or touch a known sample string, and what is then left of a candidate
if it is without a digit or without a letter. Base spans are cut out of spans of entropy,
of which what is left counts from ``WINDOW`` characters on.

Offsets are code points, ends exclusive. A text's matches come from one scan that yields what
lies before each match and the match, so offsets are sums of lengths. Texts are only
scanned where cheap tests can't rule a kind out.

A null text counts as empty and has no spans. Rows that repeat are scanned alike. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let

# The patterns and least lengths of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Least length of an assigned value. In the other two the length is part of the pattern: their matches are whole runs, so
#: a match that is too short holds none that is long enough.
LEAST = 8
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")

WINDOW = 20
#: Characters of each class and the entropy in bits from which a window counts (of 4 and 4.32 at most).
CLASSES = {"entropy_hex": (r"[0-9A-Fa-f]", 3.2), "entropy_mixed": (r"[A-Za-z0-9+/_=-]", 3.9)}
ALLOWED = r"(?i)EXAMPLE|SAMPLE|0123456789|abcdefghij|123456789012|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: What windows neither overlap nor touch: the known sample strings, those of digits as far as they overlap.
KNOWN = r"(?i:.?(?:EXAMPLE|SAMPLE|abcdefghij|(?:0123456789)+(?:012)?|(?:1234567890)+12(?:3456789)?).?)"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: Longer candidates are taken in pieces of this length that overlap by a window less one.
PIECE = 256
#: Matches of a text that are placed one after the other.
MATCHES = 256


SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _scan(pattern: str, possible: Column, kind: str) -> Column:
    """Matches of a pattern: array of (start, end, value); value is the pattern's group, or the match."""
    whole = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    value = 3 if pattern == ASSIGN else 2
    empty = F.array().cast("array<string>")
    part = lambda group: F.when(possible, F.regexp_extract_all("text", whole, F.lit(group))).otherwise(empty)
    parts = F.arrays_zip(part(1).alias("before"), part(2).alias("match"), part(value).alias("value"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + F.char_length(p["before"])
        end = begin + F.char_length(p["match"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), p["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(p["match"] != "", F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))

    def of(parts: Column) -> Column:
        """By groups of ``MATCHES``, so that the work on a text doesn't grow with the square of its matches."""
        starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(MATCHES))
        sizes = F.transform(starts, lambda at: F.aggregate(F.slice(parts, at + 1, F.lit(MATCHES)), F.lit(0), lambda n, p: n + F.char_length(p["before"]) + F.char_length(p["match"])))
        none = F.array().cast("array<" + SPAN + ">")
        group = lambda sizes: F.transform(starts, lambda at, k: F.aggregate(F.slice(parts, at + 1, F.lit(MATCHES)), F.struct(F.aggregate(F.slice(sizes, F.lit(1), k), F.lit(0), lambda n, x: n + x).alias("at"), none.alias("found")), step, lambda s: s["found"]))
        return F.flatten(let(sizes, group))

    return let(parts, of)


def _times(c: Column) -> Column:
    """c log2 c of a count."""
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def _count(character: Column, within: Column) -> Column:
    return F.char_length(within) - F.char_length(F.replace(within, character, F.lit("")))


def _windows(piece: Column, base: Column, threshold: float) -> Column:
    """Spans of windows at or above the threshold in a piece that starts at ``base``: array of (start, end)."""
    import math

    most = WINDOW * (math.log2(WINDOW) - threshold)  # the sum of c log2 c that the threshold leaves
    opening = F.substring(piece, 1, WINDOW)
    total = F.aggregate(F.array_distinct(F.filter(F.split(opening, ""), lambda c: c != "")), F.lit(0.0), lambda s, c: s + _times(_count(c, opening).cast("double")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    span = lambda at: F.struct(at.cast("int").alias("start"), (at + WINDOW).cast("int").alias("end"))
    state = F.struct(total.alias("sum"), F.when(total <= most + 1e-9, F.array(span(base))).otherwise(none).alias("found"))

    def step(s: Column, i: Column) -> Column:
        # the window moves from i - 1 to i (from 0): one character goes, one comes; rest is what stays
        rest = F.substring(piece, i + 1, F.lit(WINDOW - 1))
        counts = F.struct(_count(F.substring(piece, i, F.lit(1)), rest).cast("double").alias("out"), _count(F.substring(piece, i + WINDOW, F.lit(1)), rest).cast("double").alias("into"))
        return let(counts, lambda c: moved(s, s["sum"] - _times(c["out"] + 1) + _times(c["out"]) + _times(c["into"] + 1) - _times(c["into"]), base + i))

    def moved(s: Column, now: Column, at: Column) -> Column:
        return let(now, lambda now: F.struct(now.alias("sum"), F.when(now <= most + 1e-9, _joined(s["found"], span(at))).otherwise(s["found"]).alias("found")))

    steps = F.when(F.char_length(piece) > WINDOW, F.sequence(F.lit(1), F.char_length(piece) - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, state, step, lambda s: s["found"])


def _joined(found: Column, new: Column) -> Column:
    """Spans in order and one more, which joins the last if they touch."""
    last = F.try_element_at(found, F.lit(-1))
    longer = new.withField("start", last["start"])
    if_touching = F.concat(F.slice(found, F.lit(1), F.size(found) - 1), F.array(longer))
    return F.when((F.size(found) > 0) & (last["end"] >= new["start"]), if_touching).otherwise(F.concat(found, F.array(new)))


def _between(c: Column) -> Column:
    """What lies between the known sample strings of a candidate, as candidates."""
    whole = F.lit(rf"(?s)(.*?)(?:({KNOWN})|\z)")
    part = lambda group: F.regexp_extract_all(c["value"], whole, F.lit(group))
    start = F.struct(c["start"].alias("at"), F.array().cast("array<" + SPAN + ">").alias("found"))

    def step(state: Column, p: Column) -> Column:
        end = state["at"] + F.char_length(p["before"])
        span = F.struct(c["kind"].alias("kind"), state["at"].alias("start"), end.alias("end"), p["before"].alias("value"))
        found = F.when(F.char_length(p["before"]) >= WINDOW, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct((end + F.char_length(p["known"])).alias("at"), found.alias("found"))

    return F.aggregate(F.arrays_zip(part(1).alias("before"), part(2).alias("known")), start, step, lambda s: s["found"])


def _outside(s: Column, base: Column) -> Column:
    """What base spans (in order) leave of a span, in pieces of ``WINDOW`` characters at least."""
    over = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    start = F.struct(s["start"].alias("at"), F.array().cast("array<" + SPAN + ">").alias("found"))

    def until(state: Column, end: Column) -> Column:
        text = F.substring(s["value"], state["at"] - s["start"] + 1, end - state["at"])
        piece = F.struct(s["kind"].alias("kind"), state["at"].alias("start"), end.alias("end"), text.alias("value"))
        return F.when(end - state["at"] >= WINDOW, F.concat(state["found"], F.array(piece))).otherwise(state["found"])

    step = lambda state, b: F.struct(F.greatest(state["at"], b["end"]).alias("at"), until(state, b["start"]).alias("found"))
    return F.when(F.size(over) == 0, F.array(s)).otherwise(F.aggregate(over, start, step, lambda state: until(state, s["end"])))


def _high(candidates: str, kind: str, threshold: float) -> Column:
    """Spans of high entropy in the candidates, without those on the allow-list."""
    unknown = F.flatten(F.transform(candidates, lambda c: F.when(c["value"].rlike(UUID), F.slice(candidates, 1, 0)).when(c["value"].rlike(ALLOWED), _between(c)).otherwise(F.array(c))))
    named = F.filter(unknown, lambda c: c["value"].rlike("[0-9]") & c["value"].rlike("[A-Za-z]"))
    step = PIECE - WINDOW + 1

    def pieces(c: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.char_length(c["value"]) - WINDOW), F.lit(step))
        found = F.flatten(F.transform(starts, lambda s: let(F.substring(c["value"], s + 1, F.lit(PIECE)), lambda piece: _windows(piece, c["start"] + s, threshold))))
        # pieces overlap: spans that touch are one
        touching = F.aggregate(found, F.array().cast("array<struct<start:int,end:int>>"), lambda out, x: _joined(out, x))
        text = lambda x: F.substring(c["value"], x["start"] - c["start"] + 1, x["end"] - x["start"])
        return F.transform(touching, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), text(x).alias("value")))

    return F.flatten(F.transform(named, pieces))


def _order(spans: Column) -> Column:
    """By start, then by kind as listed."""
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), place(s).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def joined(spans: str | Column) -> Column:
    """kind:start:end of spans in order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _found(possible: Column) -> Column:
    """All spans of a text of which something is possible."""
    assign = F.filter(_scan(ASSIGN, possible["assign"], "assign"), lambda s: F.char_length(s["value"]) >= LEAST)
    base = F.struct(assign.alias("assign"), _scan(ACCESS, possible["access"], "access").alias("access"), _scan(HEX, possible["hex"], "hex").alias("hex"))

    def high(kind: str) -> Column:
        characters, threshold = CLASSES[kind]
        return let(_scan(rf"{characters}{{{WINDOW},}}", possible["entropy"], kind), lambda candidates: _high(candidates, kind, threshold))

    def with_base(kinds: Column, base: Column) -> Column:
        free = F.flatten(F.transform(F.concat(*map(high, CLASSES)), lambda s: _outside(s, base)))
        return F.struct(kinds["assign"].alias("assign"), kinds["access"].alias("access"), kinds["hex"].alias("hex"), base.alias("base"), _order(F.concat(base, free)).alias("spans"))

    return let(base, lambda kinds: let(_order(F.concat(kinds["assign"], kinds["access"], kinds["hex"])), lambda base: with_base(kinds, base)))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, assign, access, hex, base (spans of these kinds) and spans (all), as arrays of (kind, start, end, value) in order."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    names = let(F.lower("text"), lambda low: low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("apikey") | low.contains("api_key"))
    run = F.col("text").rlike(rf"{CLASSES['entropy_mixed'][0]}{{{WINDOW}}}")
    tests = F.struct(names.alias("assign"), F.col("text").contains("AKIA").alias("access"), (run & F.col("text").rlike(r"[0-9a-f]{32}")).alias("hex"), run.alias("entropy"))
    none = F.array().cast(f"array<{SPAN}>")
    nothing = F.struct(*(none.alias(c) for c in ("assign", "access", "hex", "base", "spans")))
    found = let(tests, lambda possible: F.when(possible["assign"] | possible["access"] | possible["entropy"], _found(possible)).otherwise(nothing))
    return rows.select("doc_id", found.alias("found")).select("doc_id", "found.*")
