"""Secret scans: known patterns, and strings whose characters are too evenly spread to be words.

Method: candidate strings of each character class are scanned with a sliding window. The window's
Shannon entropy comes from incremental counts: a step adds one character and drops one, and only
their two terms of the sum of c log2 c change. Windows over the class's threshold merge into
spans; windows that overlap a match of the allow list are suppressed, for a candidate is cut at
such matches and its pieces are scanned. Only DataFrame functions run here, row by row: nothing is
shuffled.

Spark has no function for match positions. A text split at its matches alternates between the
parts and the matches, so the running sum of their lengths gives every start in code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the pattern kinds (their order is the order of kinds at equal starts).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"   # a run shorter than 18 fails wherever in it the match begins
HEX = r"[0-9a-f]{16,}"          # likewise
KINDS = ("assign", "access", "hex", "entropy")

SPAN = "struct<start:bigint,kind:int,end:bigint>"


@dataclass(frozen=True)
class CharClass:
    """A class of characters, the shortest candidate, and the entropy a window has to reach."""

    name: str
    pattern: str
    window: int
    bits: float


#: Windows of 20: a random base-64 string reaches about 4.0 bits, prose of any language stays near 3.3.
CLASSES = (CharClass("base64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.9), CharClass("hexadecimal", r"[0-9A-Fa-f]{20,}", 20, 3.1))

#: Parts of candidates that are known not to be secrets: placeholder words, and candidates that are UUIDs or digits as a whole.
ALLOW = (r"(?i)example|sample|placeholder|changeme|dummy", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^[0-9+/_=-]+$")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: lambdas evaluate an expression in them anew for each element."""
    return F.get(F.transform(F.array(value), use), 0)


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"))


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def match_starts(text: Column, pattern: str, found: Column) -> Column:
    """Start of each match in code points; ``found`` are the matches, whole."""
    parts = F.split(text, pattern, -1)
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def step(s: Column, both: Column) -> Column:
        start = s["at"] + F.length(both["part"])
        return F.struct((start + F.length(both["hit"])).alias("at"), F.array_append(s["out"], start).alias("out"))

    pairs = F.zip_with(F.slice(parts, F.lit(1), F.size(found)), found, lambda p, h: F.struct(p.alias("part"), h.alias("hit")))
    return F.aggregate(pairs, state, step, lambda s: s["out"])


def pattern_spans(text: Column, pattern: str, kind: int, value: int = 0) -> Column:
    """Spans of the leftmost matches that do not overlap; with ``value``, of those whose group 1 has so many characters."""
    def spans(group: Column) -> Column:
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) if value else group
        return _let(whole, lambda hits: _let(match_starts(text, pattern, hits), lambda starts: F.zip_with(
            starts, F.arrays_zip(hits.alias("hit"), group.alias("value")),
            lambda at, m: F.struct(_span(at, kind, at + F.length(m["hit"])).alias("span"), F.length(m["value"]).alias("size")))))

    def kept(group: Column) -> Column:
        long = F.filter(spans(group), lambda s: s["size"] >= value)
        return F.when(F.exists(group, lambda g: F.length(g) >= value), F.transform(long, lambda s: s["span"])).otherwise(_none())

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if value else 0)), kept)


def _weight(count: Column) -> Column:
    """c log2 c (0 for 0)."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def high_entropy(candidate: Column, kind: CharClass) -> Column:
    """Merged [start, end) of the windows of a candidate that reach the class's entropy."""
    chars = F.filter(F.split(candidate, ""), lambda c: c != "")
    return _let(chars, lambda cs: _let(F.array_distinct(cs), lambda letters: _let(
        F.transform(cs, lambda c: F.array_position(letters, c).cast("int") - 1), lambda codes: _scan(codes, letters, kind))))


def _scan(codes: Column, letters: Column, kind: CharClass) -> Column:
    """The windows of a row of letter numbers. The state holds a count for each letter, and their sum of c log2 c."""
    w = kind.window
    limit = w * (math.log2(w) - kind.bits)  # entropy = log2 w - sum(c log2 c) / w
    steps = F.transform(codes, lambda c, i: F.struct(c.alias("new"), F.coalesce(F.get(codes, i - w), F.lit(-1)).alias("old"), i.alias("i")))
    zero = F.struct(F.transform(letters, lambda c: F.lit(0)).alias("n"), F.lit(0.0).alias("s"), F.lit(-1).alias("a"), F.lit(-1).alias("b"),
                    F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def closed(state: Column) -> Column:
        return F.array_append(state["out"], F.struct(state["a"].alias("a"), state["b"].alias("b")))

    def step(state: Column, x: Column) -> Column:
        gain, loss = F.get(state["n"], x["new"]), F.get(state["n"], x["old"])
        change = _weight(gain + 1) - _weight(gain) + F.when(x["old"] >= 0, _weight(loss - 1) - _weight(loss)).otherwise(F.lit(0.0))
        moved = x["new"] != x["old"]
        s = state["s"] + F.when(moved, change).otherwise(F.lit(0.0))
        n = F.when(moved, F.transform(state["n"], lambda v, k: F.when(k == x["new"], v + 1).when(k == x["old"], v - 1).otherwise(v))).otherwise(state["n"])
        high = (x["i"] >= w - 1) & (s <= limit + 1e-9)
        first = x["i"] - (w - 1)
        opened = high & (first > state["b"])
        return F.struct(n.alias("n"), s.alias("s"), F.when(opened, first).otherwise(state["a"]).alias("a"),
                        F.when(high, x["i"] + 1).otherwise(state["b"]).alias("b"),
                        F.when(opened & (state["a"] >= 0), closed(state)).otherwise(state["out"]).alias("out"))

    return F.aggregate(steps, zero, step, lambda state: F.when(state["a"] >= 0, closed(state)).otherwise(state["out"]))


def _pieces(candidate: Column, allow: Sequence[str]) -> Column:
    """(at, piece) of what lies before, between and after the allow-listed matches in a candidate."""
    if not allow:
        return F.array(F.struct(F.lit(0).cast("long").alias("at"), candidate.alias("piece")))
    known = "|".join(f"(?:{p})" for p in allow)

    def cut(hits: Column) -> Column:
        ends = F.zip_with(match_starts(candidate, known, hits), hits, lambda at, h: at + F.length(h))
        return F.zip_with(F.concat(F.array(F.lit(0).cast("long")), ends), F.split(candidate, known, -1),
                          lambda at, piece: F.struct(at.alias("at"), piece.alias("piece")))

    return _let(F.regexp_extract_all(candidate, F.lit(known), F.lit(0)), cut)


def entropy_spans(text: Column, kind: CharClass, allow: Sequence[str]) -> Column:
    def spans(found: Column) -> Column:
        both = F.zip_with(match_starts(text, kind.pattern, found), found, lambda at, c: F.struct(at.alias("at"), c.alias("c")))
        pieces = F.flatten(F.transform(both, lambda m: F.transform(
            _pieces(m["c"], allow), lambda p: F.struct((m["at"] + p["at"]).alias("at"), p["piece"].alias("c")))))
        long = F.filter(pieces, lambda p: F.length(p["c"]) >= kind.window)
        each = F.transform(long, lambda p: F.transform(high_entropy(p["c"], kind), lambda s: _span(p["at"] + s["a"], 3, p["at"] + s["b"])))
        return F.when(F.size(found) > 0, F.flatten(each)).otherwise(_none())

    return _let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), spans)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def secret_spans(docs: DataFrame, text_col: str = "text", classes: Sequence[CharClass] = CLASSES,
                 allow: Sequence[str] = ALLOW) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (start, kind, end) in code points, by start.

    ``base`` holds the pattern matches, whole; ``added`` the high-entropy spans that no base span
    covers (kind 3; a span that two classes find is one). Matches of ``allow`` hide the windows that
    overlap them, never the rest of a candidate. A null or empty text has none. Columns of these names are replaced; repeated
    rows are scanned alike.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.array_sort(F.concat(pattern_spans(text, ASSIGN, 0, ASSIGN_VALUE), pattern_spans(text, ACCESS, 1), pattern_spans(text, HEX, 2)))
    found = docs.withColumn("base", base)
    added = F.array_distinct(F.concat(*[entropy_spans(text, c, allow) for c in classes]))
    free = F.filter(added, lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return found.withColumn("added", F.array_sort(free))


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added) of every document."""
    found = secret_spans(docs.select("doc_id", "text"))
    def of_kind(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    count = [of_kind(k) for k in range(3)]
    return found.select("doc_id", *count, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))
