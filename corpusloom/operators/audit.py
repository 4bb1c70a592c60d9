"""Audits of numbering gaps, and the guarded repairs that they allow.

``rows`` are lines (key, pos, line). A repair is applied only if the line still is what the audit saw.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import group_or_null, strip

#: fixed patterns: an article as a heading, as a plain line, within a line, in either form, and without text of its own
HEADING = r"^\s*#{1,6}\s+제\s*(\d+)\s*조(?:\s|\(|\z)"
PLAIN = r"^(?!\s*(?:#|\||<!--|```))\s*제\s*(\d+)\s*조(?:\s|\(|\z)"
EMBEDDED = r"제\s*(\d+)\s*조\s*\([^)]{1,100}\)"
ANY_ARTICLE = r"^\s*(?:#{1,6}\s+)?제\s*\d+\s*조(?:\s|\(|\z)"
TITLED = r"^제\s*\d+\s*조\s*\("
TITLE_ONLY = r"^제\s*\d+\s*조(?:의\s*\d+)?\s*\([^()]*\)\s*\z"
#: fixed values: document kinds that repairs leave alone, those they are for, and those that compare versions
EXCLUDED = "규정|규칙|규약|정관|내규|법|시행령|시행규칙|기준|지침|요령|세칙|예규|강령|준칙|신구조문"
AGREEMENTS = "단체협약|보충협약|현장협약|임금협약|노사협약"
COMPARISON = r"신구|대비표|대조표|개정\s*\(안\)|개정안|주요개정"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
LETTERS = "가나다라마바사아자차카타파하"


def number_gaps(points: DataFrame, key: str, most: int = 100) -> DataFrame:
    """Neighbours (by pos) whose numbers leave a gap of one to ``most``: adds prev_pos, prev_number, next_* columns."""
    order = Window.partitionBy(key).orderBy("pos")
    pairs = points.select(
        key, F.lag("pos").over(order).alias("prev_pos"), F.lag("number").over(order).alias("prev_number"),
        F.col("pos").alias("next_pos"), F.col("number").alias("next_number"),
    )
    step = F.col("next_number") - F.col("prev_number")
    return pairs.filter((step > 1) & (step <= most))


def heading_gaps(rows: DataFrame, key: str = "doc_id", name: str | None = None) -> DataFrame:
    """(grade, excluded, key, line, missing, previous, next, text): article lines that fill a gap between headings.

    Grade A is a line of its own, B an article within a line. The headings around a line come from running windows, so
    gaps and lines need no range join. ``name``: column with the document name that exclusion looks at.
    """
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(key).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    number = group_or_null(F.col("line"), HEADING).try_cast("int")
    head = F.when(number.isNotNull(), F.struct(number.alias("number"), strip(F.col("line")).alias("text")))
    around = rows.withColumn("_head", head).withColumns({
        "_prev": F.last("_head", ignorenulls=True).over(before), "_next": F.first("_head", ignorenulls=True).over(after),
    })
    step = F.col("_next.number") - F.col("_prev.number")
    inside = around.filter(F.col("_head").isNull() & (step > 1) & (step <= 100))
    plain = group_or_null(F.col("line"), PLAIN).try_cast("int")
    skipped = F.regexp_like("line", F.lit(r"^\s*(?:\||<!--|```)"))
    found = F.transform(F.regexp_extract_all("line", F.lit(EMBEDDED), F.lit(1)), lambda n: n.try_cast("int"))
    embedded = F.when(skipped, F.array().cast("array<int>")).otherwise(found)
    missing = F.when(plain.isNotNull(), F.array(plain)).otherwise(embedded)
    each = inside.withColumn("_plain", plain).withColumn("missing", F.explode(missing))
    each = each.filter((F.col("missing") > F.col("_prev.number")) & (F.col("missing") < F.col("_next.number")))
    title = F.col(name) if name else F.lit("")
    return each.select(
        F.when(F.col("_plain") == F.col("missing"), "A").otherwise("B").alias("grade"),
        F.regexp_like(title, F.lit(EXCLUDED)).alias("excluded"), key, F.col("pos").alias("line"), "missing",
        F.col("_prev.text").alias("previous"), F.col("_next.text").alias("next"), strip(F.col("line")).alias("text"),
    )


def audit_summary(gaps: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row: counts by grade, eligible ones, distinct files."""
    grade_a = F.col("grade") == "A"
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return gaps.agg(
        F.count("*").alias("candidates"), count(grade_a).alias("grade_a"), count(~grade_a).alias("grade_b"),
        count(grade_a & F.col("excluded")).alias("grade_a_excluded"), count(grade_a & ~F.col("excluded")).alias("eligible"),
        F.countDistinct(key).alias("files"),
    )


REPAIR, SPLIT = "repair", "title_body_split_candidate"


def heading_candidates(gaps: DataFrame, names: DataFrame, key: str = "doc_id", name: str = "name") -> DataFrame:
    """The gaps that a repair may look at, with ``action``: grade A lines with a bracketed title, in agreements that don't
    compare versions. A line of the title alone is repaired; one whose text goes on behind it is only reported, as a heading
    with its text on one line would break what reads it. ``names``: (key, name), a row for each document."""
    named = gaps.join(names.select(key, F.col(name).alias("_name")), key)
    of_kind = F.regexp_like("_name", F.lit(AGREEMENTS)) & ~F.regexp_like("_name", F.lit(COMPARISON))
    eligible = named.filter((F.col("grade") == "A") & ~F.col("excluded") & of_kind & F.regexp_like("text", F.lit(TITLED)))
    action = F.when(F.regexp_like("text", F.lit(TITLE_ONLY)), REPAIR).otherwise(SPLIT)
    return eligible.select(*gaps.columns, action.alias("action"))


def repair_headings(rows: DataFrame, candidates: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines with ``### `` before those to repair. Raises where a line isn't what the audit saw, or is named twice."""
    wanted = candidates.filter(F.col("action") == REPAIR).groupBy(key, F.col("line").alias("pos"))
    twice = F.raise_error(F.lit("two candidates for one line")).cast("string")
    wanted = wanted.agg(F.when(F.count("*") > 1, twice).otherwise(F.max("text")).alias("_seen"))
    joined = rows.join(wanted, [key, "pos"], "left")
    stale = F.raise_error(F.lit("the line has changed since the audit")).cast("string")
    fixed = F.when(strip(F.col("line")) != F.col("_seen"), stale).otherwise(F.concat(F.lit("### "), strip(F.col("line"))))
    return joined.withColumn("line", F.when(F.col("_seen").isNull(), F.col("line")).otherwise(fixed)).drop("_seen")


#: fixed patterns: circled, numbered and lettered markers
_TOKENS = {
    "paragraph": re.compile(f"[{CIRCLED}]"),
    "item": re.compile(r"(?:^|(?<=\s))(\d{1,2})([.)])(?=\s*[가-힣A-Za-z“‘(\[])"),
    "letter": re.compile(rf"(?:^|(?<=\s))([{LETTERS}])([.)])(?=\s*[가-힣A-Za-z“‘(\[])"),
}
_SKIPPED = re.compile(r"\s*(?:\||<!--|```)")


def line_tokens(line: str) -> list[tuple[str, int, int, str, str, bool]]:
    """(level, offset, number, suffix, marker, at_start) of the markers of a line."""
    if _SKIPPED.match(line):
        return []
    out = []
    for level, pattern in _TOKENS.items():
        for m in pattern.finditer(line):
            at_start = re.fullmatch(r"\s*(?:[-*+]\s+)?", line[: m.start()]) is not None
            if level == "paragraph":
                number, suffix = CIRCLED.index(m[0]) + 1, ""
            else:
                number, suffix = int(m[1]) if level == "item" else LETTERS.index(m[1]) + 1, m[2]
            out.append((level, m.start(), number, suffix, m[0], at_start))
    return out


def markers(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, level, offset, number, suffix, marker, at_start) of every marker; built-in functions give no offsets."""
    names = ["pos", "level", "offset", "number", "suffix", "marker", "at_start"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_()]

    def run(batches):
        for batch in batches:
            at, values = [], []
            for i, (pos, line) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for token in line_tokens(line or ""):
                    at.append(i)
                    values.append((pos, *token))
            columns = [pa.array([v[k] for v in values], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], [key, *names])

    kind = rows.schema[key].dataType.simpleString()
    out = f"{key} {kind}, pos long, level string, offset int, number int, suffix string, marker string, at_start boolean"
    return rows.select(key, F.col("pos").cast("long"), "line").mapInArrow(run, out)


def marker_gaps(tokens: DataFrame, rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Markers inside a line whose neighbours start lines and count on: in the middle, or first on an article's line."""
    article = F.regexp_like("line", F.lit(ANY_ARTICLE))
    order = Window.partitionBy(key).orderBy("pos")
    parts = rows.select(key, F.col("pos").cast("long").alias("pos"), article.alias("article"),
                        F.sum(article.cast("int")).over(order).alias("part"))
    placed = tokens.join(parts, [key, "pos"])
    along = Window.partitionBy(key, "part", "level").orderBy("pos", "offset")
    near = placed.withColumns({
        f"{side}_{name}": step(name).over(along)
        for side, step in (("prev", F.lag), ("next", F.lead)) for name in ("number", "suffix", "at_start")
    })
    continues = F.col("next_at_start") & (F.col("next_suffix") == F.col("suffix"))
    middle = (
        F.col("prev_at_start") & (F.col("prev_suffix") == F.col("suffix")) & continues
        & (F.col("prev_number") == F.col("number") - 1) & (F.col("next_number") == F.col("number") + 1)
    )
    first = (F.col("number") == 1) & F.col("article") & continues & (F.col("next_number") == 2)
    middle, first = F.coalesce(middle, F.lit(False)), F.coalesce(first, F.lit(False))
    found = near.filter(~F.col("at_start") & (middle | first))
    return found.select(key, "pos", "level", "offset", "marker", F.when(middle, "middle").otherwise("first").alias("reason"))


def repair_markers(rows: DataFrame, gaps: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines with a break before each reported marker, cut from left to right at the sorted offsets.

    Raises where the marker isn't at its offset any more.
    """
    cuts = gaps.groupBy(key, "pos").agg(F.array_sort(F.collect_set(F.struct("offset", "marker"))).alias("_cuts"))
    joined = rows.join(cuts, [key, "pos"], "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(state, c):
        found = F.substring(F.col("line"), c["offset"] + 1, F.length(c["marker"]))
        piece = F.substring(F.col("line"), state["at"] + 1, c["offset"] - state["at"])
        error = F.raise_error(F.lit("the marker has moved since the audit")).cast("string")
        text = F.when(found != c["marker"], error).otherwise(F.rtrim(piece))
        return F.struct(c["offset"].alias("at"), F.concat(state["out"], text, F.lit("\n")).alias("out"))

    done = F.aggregate("_cuts", start, cut, lambda s: F.concat(s["out"], F.substring(F.col("line"), s["at"] + 1, F.length("line"))))
    return joined.withColumn("line", F.coalesce(done, F.col("line"))).drop("_cuts")
