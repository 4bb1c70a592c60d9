"""Secret scan: fixed key patterns, and a sliding-window entropy test of candidate strings. Built-in functions only.

A candidate is a run of 20 or more of ``[A-Za-z0-9+/_=-]`` with a digit in it. Its character class (hexadecimal or
base64) sets the entropy that some window of ``WINDOW`` characters must reach. A window's entropy follows from the last
one's: counts of the characters in the window are kept, and the one that enters and the one that leaves change the sum of
``c * log2(c)`` by a difference that their own counts give. Candidates that the allow-list matches are suppressed. All work is within a row, so nothing is shuffled.

Spans are ``kind:start:end`` in code points, the end exclusive, by start, then in the order of ``KINDS``.

Edge cases: a null text is an empty one; without spans the list is empty and the digest that of an empty string.
Repeated rows and ids are scanned row by row. An empty table gives an empty result. Extra columns are not read. Whole
texts are scanned.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
# fixed patterns of the base kinds; a group's minimum length is applied to what has been matched
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
RUN = 256
#: code points of candidates run from ``+`` to ``z``
FIRST, CODES = ord("+"), ord("z") - ord("+") + 1
HEX_BITS, BASE64_BITS = 2.83, 3.61
#: digits and separators only; letters and separators with few digits at the end; paths; placeholders. No pattern nests
#: one repetition in another, so each takes time in proportion to its candidate
ALLOW = (
    r"^[0-9+/_=-]+$",
    r"^[A-Za-z][A-Za-z_/=+-]*[0-9]{0,4}$",
    r"^[A-Za-z/]{3,}/[A-Za-z0-9-]*$",
    r"(?i)(example|placeholder|changeme|x{6,}|0{8,}|123456789)",
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, though the expression names it often or within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str, *groups: int) -> Column:
    """array<struct<start, end, match, g0, ...>> of the matches of a pattern, leftmost and not overlapping.

    A match starts after the pieces and matches before it, so positions come from lengths alone. Matches are folded in
    runs of ``RUN``, so that an array that grows by copying stays short however many matches a text has.
    """
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, *groups)]
    names = ["match", *(f"g{i}" for i in range(len(groups)))]
    kept = "".join(f", {n}: string" for n in names)
    empty = F.array().cast(f"array<struct<start: int, end: int{kept}>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), end.alias("end"), *(x[n].alias(n) for n in names))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def fold(run: Column, start: Column) -> Column:
        return F.aggregate(run, F.struct(start.alias("at"), empty.alias("out")), step, lambda s: s["out"])

    def length(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda n, x: n + F.length(x["piece"]) + F.length(x["match"]))

    def starts(runs: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            F.transform(runs, length), first,
            lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    def walk(zipped: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(zipped), F.lit(RUN)), lambda i: F.slice(zipped, i, F.lit(RUN)))
        return bound(runs, lambda r: F.flatten(F.zip_with(r, starts(r), fold)))

    def zipped(matches: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches["m0"]))
        columns = (matches[f"m{i}"].alias(n) for i, n in enumerate(names))
        return F.when(F.size(matches["m0"]) > 0, bound(F.arrays_zip(pieces.alias("piece"), *columns), walk)).otherwise(empty)

    return bound(F.struct(*(f.alias(f"m{i}") for i, f in enumerate(found))), zipped)


def hot_windows(candidate: Column, threshold: Column) -> Column:
    """struct<first, last>: starts (from 0) of the first and last window that reaches the threshold; nulls if none.

    The state of the walk holds how often each character stands in the window, a byte for each code point of candidates.
    """
    gain = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 2)]
    rise = F.array(*(F.lit(gain[c + 1] - gain[c]) for c in range(WINDOW + 1)))
    digits = F.lit(bytes(range(WINDOW + 1)))
    most = WINDOW * (F.lit(math.log2(WINDOW)) - threshold)

    def byte(n: Column) -> Column:
        return F.substring(digits, n + 1, F.lit(1))

    def walk(given: Column) -> Column:
        raw = given["raw"]

        def value(text: Column, at: Column) -> Column:
            return F.ascii(F.substring(text, at, F.lit(1)).cast("string"))

        def move(state: Column, p: Column, c: Column) -> Column:
            """The state after one character has left (none if ``out`` is null) and one has come in."""
            counts = F.coalesce(F.overlay(state["counts"], byte(c["n_out"] - 1), c["out"], F.lit(1)), state["counts"])
            total = state["sum"] - F.coalesce(F.get(rise, c["n_out"] - 1), F.lit(0.0)) + F.get(rise, c["n_in"])
            return F.struct(
                total.alias("sum"), F.overlay(counts, byte(c["n_in"] + 1), c["in"], F.lit(1)).alias("counts"),
                F.when((p >= WINDOW) & (total <= given["most"]), p - WINDOW).alias("hot"), state["first"], state["last"],
            )

        def step(state: Column, p: Column) -> Column:
            place = F.struct((value(raw, p) - (FIRST - 1)).alias("in"), F.when(p > WINDOW, value(raw, p - WINDOW) - (FIRST - 1)).alias("out"))

            def counted(x: Column) -> Column:
                n_in = value(state["counts"], x["in"]) - F.when(x["in"] == x["out"], 1).otherwise(0)
                return F.struct(x["in"].alias("in"), x["out"].alias("out"), n_in.alias("n_in"), value(state["counts"], x["out"]).alias("n_out"))

            moved = bound(bound(place, counted), lambda c: move(state, p, c))
            return bound(moved, lambda m: F.struct(
                m["sum"].alias("sum"), m["counts"].alias("counts"), F.coalesce(m["first"], m["hot"]).alias("first"),
                F.coalesce(m["hot"], m["last"]).alias("last"),
            ))

        none = F.lit(None).cast("int")
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(bytes(CODES)).alias("counts"), none.alias("first"), none.alias("last"))
        return F.aggregate(
            F.sequence(F.lit(1), F.length(raw)), start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
        )

    return bound(F.struct(candidate.cast("binary").alias("raw"), most.alias("most")), walk)


def allowed(candidate: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOW:
        out = out | F.regexp_like(candidate, F.lit(pattern))
    return out


def entropy_spans(text: Column) -> Column:
    """array<struct<start, end>> of what the windows over the threshold cover in each candidate."""
    suspects = F.filter(located(text, CANDIDATE), lambda x: ~allowed(x["match"]))

    def test(x: Column) -> Column:
        bits = F.when(F.regexp_like(x["match"], F.lit("^([0-9a-f]+|[0-9A-F]+)$")), HEX_BITS).otherwise(BASE64_BITS)
        return bound(
            hot_windows(x["match"], bits),
            lambda hot: F.struct(x["start"].alias("start"), hot["first"].alias("first"), hot["last"].alias("last")),
        )

    hit = F.filter(F.transform(suspects, test), lambda x: x["first"].isNotNull())
    return F.transform(
        hit,
        lambda x: F.struct(
            (x["start"] + x["first"]).alias("start"), (x["start"] + x["last"] + WINDOW).alias("end")
        ),
    )


def _kind(spans: Column, number: int) -> Column:
    return F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"))
    )


def _text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, assign, access, hex, entropy) of every row; each kind is an array of structs with start and end."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("_text"))
    assign = F.filter(located(F.col("_text"), ASSIGN, 2), lambda x: F.length(x["g0"]) >= ASSIGN_LEAST)
    access = F.filter(located(F.col("_text"), ACCESS), lambda x: F.length(x["match"]) >= ACCESS_LEAST)
    return rows.select(
        id_col, assign.alias("assign"), access.alias("access"), located(F.col("_text"), HEX).alias("hex"),
        entropy_spans(F.col("_text")).alias("entropy"),
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    found = scan(docs, id_col, text_col)
    base = F.concat(*(_kind(F.col(k), i) for i, k in enumerate(KINDS[:3])))
    every = F.concat(*(_kind(F.col(k), i) for i, k in enumerate(KINDS)))
    return found.select(
        id_col,
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_text(base), 256).alias("base_sha256"),
        _text(every).alias("spans"),
    )
