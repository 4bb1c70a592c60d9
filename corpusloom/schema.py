"""Table schemas, declared once and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
    "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType()),
    "array<float>": T.ArrayType(T.FloatType()), "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _schema(text: str) -> T.StructType:
    """A schema from ``name type`` pairs; needs no session, unlike Spark's own parser."""
    pairs = (field.split() for field in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


INSTITUTIONS = _schema("inst_code string, inst_name string, ministry string")
DOCUMENTS = _schema(
    "doc_id string, corpus string, rel_path string, inst_code string, category string, doc_title string, alias string, "
    "doc_type string, doc_date string, n_articles int, coverage double, parse_status string, usecases array<string>"
)
ARTICLES = _schema(
    "id long, doc_id string, seq int, section string, chapter string, art_no int, art_sub int, title string, "
    "body string, n_chars int"
)
STAGED_DOCUMENTS = _schema(
    "doc_id string, corpus string, rel_path string, doc_title string, doc_type string, inst_code string, "
    "inst_name string, ministry string, category string, doc_date string, alias string, n_articles int, "
    "content_chars int, covered_chars int, coverage double, parse_status string, meta map<string,string>"
)
STAGED_ARTICLES = _schema(
    "doc_id string, seq int, section string, chapter string, art_no int, art_sub int, title string, text string, "
    "n_chars int"
)
EMBEDDINGS = _schema("text_hash string, embedding array<float>, model string")
LOAD_RUNS = _schema(
    "id string, script string, mode string, corpus string, started_at timestamp, finished_at timestamp, n_docs long, "
    "n_articles long"
)
CATALOG = _schema(
    "report_form_root_no string, item_name string, major_category string, minor_category string, cycle_type string, "
    "disclosure_kind string"
)
MAIN_SECTION, ADDENDUM = "본칙", "부칙"
CORPUS_ORDER = {"legal": 0, "ca": 1, "bylaws": 2, "disclosure": 3}
