"""Null-safe text columns.

White space includes the ideographic, no-break and zero-width no-break spaces, which Java's ``\\s`` leaves out. ``\\z`` is
used where a pattern must end with the text, as Java's ``$`` also stops before a last line break.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.rules import VALUE_WORDS

SPACE = r"[\s　 ﻿]"
CONTROL = r"[\x01-\x08\x0B\x0C\x0E-\x1F\x7F]"
ARTICLE_REFERENCE = r"제\s*(\d+)\s*조(?:\s*의\s*(\d+))?"
#: fixed values: document kinds, the leftmost of which in a title is its type
DOCUMENT_TYPES = (
    "시행규칙", "시행령", "법률", "기본법", "특별법", "단체협약", "노사합의", "취업규칙", "규정", "지침", "규칙", "세칙",
    "요령", "기준", "매뉴얼", "가이드라인", "편람", "예규", "고시", "훈령", "법",
)
OTHER_TYPE = "기타"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def squash(text: Column) -> Column:
    """Runs of white space as one blank, none at either end."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def filled(*columns: Column, default: str | None = None) -> Column:
    """First value that is neither null nor empty."""
    found = F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))
    return found if default is None else F.coalesce(found, F.lit(default))


def group_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """A regex group; null where nothing or an empty text matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def int_or_null(text: Column) -> Column:
    """Leading digits as an integer; null where there are none."""
    return group_or_null(text, r"^\s*([+-]?\d+)").try_cast("int")


def article_label(number: Column, sub: Column) -> Column:
    """제N조 or 제N조의M; empty without a number."""
    tail = F.when(sub.isNull(), "").otherwise(F.concat(F.lit("의"), sub.cast("string")))
    label = F.concat(F.lit("제"), number.cast("string"), F.lit("조"), tail)
    return F.when(number.isNull(), "").otherwise(label)


def article_reference(text: Column) -> Column:
    """struct<number, sub> of the first article that a text names."""
    return F.struct(
        group_or_null(text, ARTICLE_REFERENCE, 1).try_cast("int").alias("number"),
        group_or_null(text, ARTICLE_REFERENCE, 2).try_cast("int").alias("sub"),
    )


def preview(text: Column, length: int) -> Column:
    """One line, cut to a length with an ellipsis."""
    line = squash(F.coalesce(text, F.lit("")))
    return F.when(F.length(line) > length, F.concat(F.substring(line, 1, length), F.lit("…"))).otherwise(line)


def body_preview(body: Column, whole: bool, length: int = 200) -> Column:
    return body if whole else F.substring(body, 1, length)


def safe_segment(text: Column) -> Column:
    """A path segment: reserved characters become underscores."""
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), r'[/:*?"<>|]', "_"))


def first_bytes(text: Column, most: int) -> Column:
    """The longest prefix of whole characters within a number of UTF-8 bytes."""
    state = F.struct(F.lit(0).alias("size"), F.lit("").alias("kept"))

    def step(s: Column, ch: Column) -> Column:
        size = s["size"] + F.octet_length(ch)
        return F.struct(size.alias("size"), F.when(size <= most, F.concat(s["kept"], ch)).otherwise(s["kept"]).alias("kept"))

    walk = F.aggregate(F.split(F.substring(text, 1, most), ""), state, step, lambda s: s["kept"])
    return F.when(F.octet_length(text) <= most, text).otherwise(walk)


def institution_folder(ministry: Column, name: Column, code: Column) -> Column:
    """[ministry]name_code."""
    plain = F.regexp_replace(F.coalesce(ministry, F.lit("")), r"[\[\]]", "")
    return F.concat(
        F.lit("["), plain, F.lit("]"), safe_segment(filled(name, default="UnknownInstitution")), F.lit("_"),
        safe_segment(filled(code, default="UnknownCode")),
    )


def report_folder(code: Column, item: Column, year: Column) -> Column:
    """code_item/year."""
    return F.concat_ws(
        "/",
        F.concat_ws("_", F.coalesce(F.trim(code), F.lit("")), safe_segment(filled(item, default="UnknownItem"))),
        filled(year, default="UnknownYear"),
    )


def title_key(title: Column) -> Column:
    """A law title for comparison: one kind of middle dot, no white space."""
    dots = F.regexp_replace(F.coalesce(title, F.lit("")), "[·ㆍ•]", "·")
    return F.regexp_replace(dots, f"{SPACE}+", "")


def label_key(label: Column) -> Column:
    """A field label without white space and punctuation."""
    return F.regexp_replace(F.coalesce(label, F.lit("")), r"[\s 　()\[\]{}<>·,./\\\-_=|:]+", "")


def without_links(text: Column) -> Column:
    return F.regexp_replace(text, r"\[([^\]]+)\]\(([^)]+)\)", "$1")


def year_of(date: Column, title: Column) -> Column:
    """Four-digit year from a date, else from a title that names one; null if neither does."""
    return F.coalesce(group_or_null(date, r"(20\d{2})"), group_or_null(title, r"(20\d{2})\s*년"))


def report_year(year: Column, title: Column, date: Column) -> Column:
    """Given year, else the one that starts the title, else the one in the date; empty if there is none."""
    return filled(year, group_or_null(title, r"^(\d{4})"), group_or_null(date, r"(20\d{2})"), default="")


def dotted_date(digits: Column) -> Column:
    """YYYYMMDD as YYYY.MM.DD; anything else as it is."""
    return F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})\z", "$1.$2.$3")


def date_in_name(name: Column) -> Column:
    """ISO date from a file name with YYYYMMDD, YYYY.M.D or YYYY-M-D."""
    packed = r"(20\d{2})(\d{2})(\d{2})"
    apart = r"(20\d{2})[.\-_]\s*(\d{1,2})[.\-_]\s*(\d{1,2})"
    iso = lambda p: F.concat_ws(
        "-", group_or_null(name, p, 1), F.lpad(group_or_null(name, p, 2), 2, "0"), F.lpad(group_or_null(name, p, 3), 2, "0")
    )
    return F.when(F.regexp_like(name, F.lit(packed)), iso(packed)).when(F.regexp_like(name, F.lit(apart)), iso(apart))


def tags(text: Column) -> Column:
    """Comma-separated lower-case tags as an array; null if none is well-formed."""
    parts = F.transform(F.split(text, ","), lambda x: strip(x))
    kept = F.filter(parts, lambda x: F.regexp_like(x, F.lit(r"^[a-z_]+\z")))
    return F.when(F.size(kept) > 0, kept)


def document_type(title: Column) -> Column:
    """The leftmost known kind in a title."""
    return F.coalesce(group_or_null(title, f"({'|'.join(DOCUMENT_TYPES)})"), F.lit(OTHER_TYPE))


def first_family(text: Column, families: dict[str, list[str]], default: str) -> Column:
    """Bracketed label, else the first family with a word in the text, else the default."""
    out = F.when(group_or_null(text, r"^\s*\[([^\]]+)\]").isNotNull(), group_or_null(text, r"^\s*\[([^\]]+)\]"))
    for name, words in families.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        out = out.when(hit, name)
    return out.otherwise(default)


def is_sentence(text: Column) -> Column:
    return (F.length(text) >= 10) & F.regexp_like(text, F.lit(SPACE))


def rewrite_fits(rewrite: Column, query: Column, endings: str = r"[.?!]\z") -> Column:
    """Whether a rewritten query is usable: 2 to 60 characters, changed, and not a sentence."""
    n = F.length(rewrite)
    return F.coalesce((n >= 2) & (n <= 60) & (rewrite != query) & ~F.regexp_like(rewrite, F.lit(endings)), F.lit(False))


def looks_like_value(cell: Column, words: tuple[str, ...] = VALUE_WORDS) -> Column:
    """Whether a table cell holds a value: a number, date, time, quarter, amount, or a listed word (white space apart)."""
    text = strip(F.coalesce(cell, F.lit("")))
    # fixed patterns: numbers with and without separators, dates, times, quarters, amounts
    patterns = [
        r"(?i)^(N/A|NA|null)\z", r"^[+-]?\d{1,3}(,\d{3})*(\.\d+)?%?\z", r"^\d+(\.\d+)?\z",
        r"^\d{4}년(\s*\d{1,2}월)?(\s*\d{1,2}일)?\z", r"^\d{1,2}:\d{2}\z", r"^\d{4}\s*/\s*\d{1,2}\z",
        r"^\d{4}\s*년\s*\d{1,2}\s*/\s*\d{1,2}\s*분기\z", r"^\d+(\.\d+)?(명|원|%)\z",
    ]
    hit = F.regexp_replace(text, r"\s+", "").isin(*words) if words else F.lit(False)
    for pattern in patterns:
        hit = hit | F.regexp_like(text, F.lit(pattern))
    return hit


def has_nul(text: Column) -> Column:
    return text.contains("\0")


def has_control(text: Column) -> Column:
    return F.regexp_like(text, F.lit(CONTROL))


def without_control(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00\x01-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def front_matter(text: Column) -> Column:
    """map of the ``key: value`` lines between two ``---`` lines at the start; empty without them."""
    block = F.regexp_extract(text, r"\A---\r?\n((?:.*\r?\n){0,38}?)---(?:\r?\n|\z)", 1)
    line = r"(?m)^(\w+):\s*'?(.*?)'?\s*$"
    keys, values = F.regexp_extract_all(block, F.lit(line), F.lit(1)), F.regexp_extract_all(block, F.lit(line), F.lit(2))
    # the last of equal keys wins
    last = F.filter(F.arrays_zip(keys.alias("k"), values.alias("v"), F.sequence(F.lit(1), F.size(keys)).alias("i")),
                    lambda x: ~F.array_contains(F.slice(keys, x["i"] + 1, F.size(keys)), x["k"]))
    pairs = F.transform(last, lambda x: F.struct(x["k"], x["v"]))
    return F.when(F.size(keys) > 0, F.map_from_entries(pairs)).otherwise(F.create_map().cast("map<string,string>"))


def without_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, r"\A---\r?\n(?:.*\r?\n){0,38}?---(?:\r?\n|\z)", "")


def html_to_text(html: Column, labels: tuple[str, ...] = ()) -> Column:
    """Text of a page: no scripts, styles or tags, common entities decoded, one blank between words.

    Labels start a heading line of their own.
    """
    text = F.regexp_replace(html, r"(?is)<script.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style.*?</style>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    entities = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&apos;", "'"),
                ("&quot;", '"'))
    for entity, char in entities:
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = squash(text)
    for label in labels:
        text = F.replace(text, F.lit(label), F.lit(f"\n### {label}\n"))
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n")) if labels else text


def links(html: Column) -> Column:
    """array<struct<href, label>> of the anchors of a page, in order."""
    anchor = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    found = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(anchor), F.lit(1)).alias("href"),
        F.regexp_extract_all(html, F.lit(anchor), F.lit(2)).alias("label"),
    )
    return F.transform(found, lambda x: F.struct(x["href"].alias("href"), html_to_text(x["label"]).alias("label")))


def call_arguments(html: Column, function: str) -> Column:
    """array<struct<a, b, c>> of the quoted arguments of three-argument script calls."""
    call = rf"{function}\(\s*'([^']*)'\s*,\s*'([^']*)'\s*,\s*'([^']*)'\s*\)"
    parts = [F.regexp_extract_all(html, F.lit(call), F.lit(i)) for i in (1, 2, 3)]
    return F.arrays_zip(*(p.alias(n) for p, n in zip(parts, "abc", strict=True)))


def _pairs(html: Column, pattern: str, first: str, second: str) -> Column:
    """array<struct> of a pattern's two groups, trimmed; of pairs with one first group or an empty one the first stays."""
    found = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias(first), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias(second)
    )
    found = F.transform(found, lambda x: F.struct(strip(x[first]).alias(first), strip(x[second]).alias(second)))
    found = F.filter(found, lambda x: (x[first] != "") & (x[second] != ""))
    fresh = lambda kept, x: ~F.exists(kept, lambda k: k[first] == x[first])
    add = lambda kept, x: F.when(fresh(kept, x), F.concat(kept, F.array(x))).otherwise(kept)
    return F.aggregate(found, F.array().cast(f"array<struct<{first}: string, {second}: string>>"), add)


def file_links(html: Column) -> Column:
    """array<struct<file_no, name>> of the links to stored files, each file once."""
    return _pairs(html, r"fileNo=(\d+)[^>]*>\s*([^<]+?)\s*<", "file_no", "name")


def option_values(html: Column) -> Column:
    """array<struct<value, label>> of the choices of a page's select boxes."""
    return _pairs(html, r'(?i)<option\s[^>]*?value="([^"]*)"[^>]*>([^<]*)<', "value", "label")


def section_files(html: Column, labels: tuple[str, ...]) -> Column:
    """array<struct<label, files>>: file links between a table heading with one of the labels and the next heading."""
    head = r"<th[^>]*>\s*([^<]{1,30}?)\s*</th>"
    names, parts = F.regexp_extract_all(html, F.lit(head), F.lit(1)), F.split(html, head, -1)
    sections = F.arrays_zip(names.alias("label"), F.slice(parts, F.lit(2), F.size(names)).alias("part"))
    found = F.transform(sections, lambda x: F.struct(strip(x["label"]).alias("label"), file_links(x["part"]).alias("files")))
    return F.filter(found, lambda x: x["label"].isin(*labels) & (F.size(x["files"]) > 0))


def markdown_links(text: Column) -> Column:
    """array<struct<label, target>> of Markdown links that aren't images."""
    link = r"(?<!!)\[([^\]]*)\]\(([^)\s]+)\)"
    return F.arrays_zip(
        F.regexp_extract_all(text, F.lit(link), F.lit(1)).alias("label"),
        F.regexp_extract_all(text, F.lit(link), F.lit(2)).alias("target"),
    )


def without_dangling_images(text: Column) -> Column:
    """Without image references whose target is neither a URL nor inline data."""
    return F.regexp_replace(text, r"!\[[^\]]*\]\((?!https?://|data:)[^)]*\)", "")


def shifted_pages(text: Column, first: int) -> Column:
    """Page markers ``<!-- page: N -->`` moved on by ``first`` pages."""
    pieces = F.split(text, r"<!-- page: \d+ -->", -1)
    numbers = F.regexp_extract_all(text, F.lit(r"<!-- page: (\d+) -->"), F.lit(1))
    marks = F.transform(numbers, lambda n: F.concat(F.lit("<!-- page: "), (n.cast("int") + first).cast("string"), F.lit(" -->")))
    tail = F.zip_with(marks, F.slice(pieces, F.lit(2), F.size(marks)), lambda m, p: F.concat(m, p))
    return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))


def download_url(base: str, **parameters: Column) -> Column:
    """A URL with encoded query parameters."""
    parts = [F.concat(F.lit(f"{name}="), F.url_encode(F.coalesce(value, F.lit("")))) for name, value in parameters.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *parts))
