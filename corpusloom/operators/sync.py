"""Incremental sync: what a feed has that the store lacks, checkpoints, retries and revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import filled, group_or_null, title_key
from corpusloom.operators.ranking import first_by


def route_feed(feed: DataFrame, stored: DataFrame, scoped: DataFrame, institutions: DataFrame) -> DataFrame:
    """Feed rows (disclosure_no, report_no, inst_name) with ``route``: stored, out_of_scope, unmatched or missing, in that
    order of precedence; rows without a number are skipped. Missing rows get the institution's code."""
    rows = feed.filter(F.trim(F.coalesce("disclosure_no", F.lit(""))) != "").withColumn("inst_name", F.trim("inst_name"))
    rows = rows.join(stored.select("disclosure_no", F.lit(True).alias("_stored")).distinct(), "disclosure_no", "left")
    rows = rows.join(scoped.select("report_no", F.lit(True).alias("_scoped")).distinct(), "report_no", "left")
    # of institutions with one name, the last by code is the one a name stands for
    named = institutions.groupBy("inst_name").agg(F.max("inst_code").alias("inst_code"))
    rows = rows.join(named, "inst_name", "left")
    route = (
        F.when(F.col("_stored"), "stored").when(F.col("_scoped").isNull(), "out_of_scope")
        .when(F.col("inst_code").isNull(), "unmatched").otherwise("missing")
    )
    return rows.withColumn("route", route).drop("_stored", "_scoped")


def open_pairs(institutions: DataFrame, codes: DataFrame, done: DataFrame) -> DataFrame:
    """All (inst_code, report_no) pairs that aren't done.

    Each institution's done codes are one set, and what the list of codes has beyond it is taken within the row: only open
    pairs ever become rows. ``codes`` is a configured list; it stands in one row and is broadcast. Null codes are no pairs.
    """
    listed = codes.filter("report_no is not null").agg(F.sort_array(F.collect_set("report_no")).alias("_codes"))
    finished = done.join(F.broadcast(codes.select("report_no").distinct()), "report_no", "left_semi")
    finished = finished.groupBy("inst_code").agg(F.collect_set("report_no").alias("_done"))
    rows = institutions.select("inst_code").distinct().join(finished, "inst_code", "left").crossJoin(F.broadcast(listed))
    left = F.array_except("_codes", F.coalesce("_done", F.slice("_codes", 1, 0)))
    return rows.select("inst_code", F.explode(left).alias("report_no"))


def missing(live: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Live rows that the store lacks; a row without a key is no candidate."""
    for key in keys:
        live = live.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return live.join(stored.select(*keys), list(keys), "left_anti")


def stored_number(record_id: Column) -> Column:
    """The third part of an id ``a:b:c``."""
    return F.split_part(record_id, F.lit(":"), F.lit(3))


def retry_targets(missing_rows: DataFrame, missing_files: DataFrame) -> DataFrame:
    """(inst_code, report_no, disclosure_no, reason): missing rows, then those with a missing file that aren't there yet."""
    keys = ["inst_code", "report_no", "disclosure_no"]
    first = missing_rows.select(*keys, F.lit(None).cast("string").alias("reason"))
    files = missing_files.select(*keys).distinct().withColumn("reason", F.lit("missing_file"))
    fresh = files.join(missing_rows.select(*(F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys)), keys, "left_anti")
    return first.unionByName(fresh)


def by_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows that the targets name. A target without a number takes all rows of its pair, whatever else names it."""
    blank = F.trim(F.coalesce("disclosure_no", F.lit(""))) == ""
    pair = ["inst_code", "report_no"]
    whole = targets.filter(blank).select(*pair).distinct()
    named = targets.filter(~blank).select(*pair, "disclosure_no").distinct()
    rest = rows.join(whole, pair, "left_anti").join(named, [*pair, "disclosure_no"], "left_semi").select(*rows.columns)
    return rows.join(whole, pair, "left_semi").select(*rows.columns).unionByName(rest)


def not_in_checkpoint(rows: DataFrame, checkpoint: DataFrame, key: str, date: str, strict: bool = False) -> DataFrame:
    """Rows to fetch. A known key is skipped if the dates are equal or, unless ``strict``, either is blank."""
    known = checkpoint.select(key, F.coalesce(F.col(date), F.lit("")).alias("_date"), F.lit(True).alias("_known"))
    own = F.coalesce(F.col(date), F.lit(""))
    same = F.col("_date") == own
    same = same if strict else same | (F.col("_date") == "") | (own == "")
    return rows.join(known, key, "left").filter(~F.coalesce(F.col("_known") & same, F.lit(False))).drop("_date", "_known")


def union_checkpoints(old: DataFrame, new: DataFrame, key: str, date: str) -> DataFrame:
    """All keys of either; the new date where it is there and differs."""
    both = old.select(key, F.col(date).alias("_old")).join(new.select(key, F.col(date).alias("_new")), key, "full")
    return both.select(key, filled(F.col("_new"), F.col("_old")).alias(date))


def seed_checkpoint(old: DataFrame, manifests: DataFrame, key: str) -> DataFrame:
    """The checkpoint and the manifests' keys that it lacks; blank and zero keys are left out."""
    fresh = manifests.filter(~F.coalesce(F.col(key), F.lit("")).isin("", "0")).withColumn("seeded", F.lit(True))
    fresh = first_by(fresh.join(old.select(key), key, "left_anti"), [key], [F.col(c) for c in manifests.columns])
    return old.unionByName(fresh, allowMissingColumns=True)


def merge_index(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """New rows win by id; ids that start with ``::`` are dropped."""
    kept = old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    return kept.filter(~F.col(key).startswith("::"))


def add_archive_members(index: DataFrame, members: DataFrame, path: str = "file_path", key: str = "id") -> DataFrame:
    """Members of archives whose path and id are both unknown."""
    fresh = members.join(index.select(path), path, "left_anti").join(index.select(key), key, "left_anti")
    return index.unionByName(fresh, allowMissingColumns=True)


def merge_status(main: DataFrame, instance: DataFrame, key: str = "id") -> DataFrame:
    """A worker's successes replace what isn't a success in the main map; new successes are added."""
    good = instance.filter("status = 'success'")
    stays = main.filter("status = 'success'").join(good.select(key), key, "left_semi")
    kept = main.join(good.select(key), key, "left_anti").unionByName(stays)
    return kept.unionByName(good.join(kept.select(key), key, "left_anti"), allowMissingColumns=True)


def revisions(sources: DataFrame, listed: DataFrame) -> DataFrame:
    """Sources (id, title, source_url, effective_date) with a newer version in ``listed`` (title, seq, effective_date,
    current). Titles are compared without white space and with one kind of dot; a current version goes before others. A
    version is newer if its number differs and the source has no date or an earlier one."""
    old = sources.withColumn("old_seq", F.coalesce(group_or_null(F.col("source_url"), r"(?:lsiSeq|admRulSeq)=(\d+)"), F.lit("")))
    new = listed.select(title_key(F.col("title")).alias("_key"), F.col("seq").alias("new_seq"),
                        F.col("effective_date").alias("new_date"), F.coalesce("current", F.lit(False)).alias("_current"))
    new = first_by(new.filter("coalesce(new_seq, '') <> ''"), ["_key"], [F.desc("_current"), F.col("new_date"), F.col("new_seq")])
    rows = old.withColumn("_key", title_key(F.col("title"))).join(new, "_key")
    later = F.col("effective_date").isNull() | (F.col("effective_date") == "") | (F.col("new_date") > F.col("effective_date"))
    out = rows.filter((F.col("old_seq") != F.col("new_seq")) & later)
    return out.select("id", "title", "old_seq", "new_seq", F.col("effective_date").alias("old_date"), "new_date")


def apply_revisions(sources: DataFrame, found: DataFrame) -> DataFrame:
    """Sources with the new number in the URL, the old one kept, and status planned."""
    new = found.select("id", "new_seq", "new_date")
    rows = sources.join(new, "id", "left")
    url = F.regexp_replace("source_url", F.lit(r"((?:lsiSeq|admRulSeq)=)\d+"), F.concat(F.lit("$1"), F.col("new_seq")))
    changed = F.col("new_seq").isNotNull()
    return rows.withColumns({
        "previous_seq": F.when(changed, group_or_null(F.col("source_url"), r"(?:lsiSeq|admRulSeq)=(\d+)")),
        "source_url": F.when(changed, url).otherwise(F.col("source_url")),
        "status": F.when(changed, F.lit("planned")).otherwise(F.col("status")),
        "effective_date": F.when(changed, F.col("new_date")).otherwise(F.col("effective_date")),
    }).drop("new_seq", "new_date")


def add_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """New sources unless the number in their URL, or title and category, are known."""
    seq = lambda: group_or_null(F.col("source_url"), r"(?:lsiSeq|admRulSeq)=(\d+)")
    known = old.select(seq().alias("_seq")).filter("_seq is not null").distinct()
    fresh = new.withColumn("_seq", seq()).join(known, "_seq", "left_anti").drop("_seq")
    fresh = fresh.join(old.select("title", "category"), ["title", "category"], "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def prefer_first_source(arms: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of the first arm that has any for their key."""
    every = None
    for number, arm in enumerate(arms):
        own = arm.withColumn("_arm", F.lit(number))
        every = own if every is None else every.unionByName(own, allowMissingColumns=True)
    first = every.groupBy(*keys).agg(F.min("_arm").alias("_arm"))
    return every.join(first, [*keys, "_arm"], "left_semi").drop("_arm")


def newest_version(rows: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Adds ``version_suffix``: empty for the last of a key's rows, _v01, _v02, ... for older ones."""
    from pyspark.sql import Window

    own = Window.partitionBy(*keys)
    number = F.row_number().over(own.orderBy(place))
    last = number == F.count("*").over(own)
    return rows.withColumn("version_suffix", F.when(last, "").otherwise(F.format_string("_v%02d", number)))


def alternate_names(rows: DataFrame, folder: str, name: str, size: str) -> DataFrame:
    """One row for each (folder, name, size); different sizes under one name get ``_alt2``, ``_alt3``, ... in order."""
    from pyspark.sql import Window

    distinct = rows.select(folder, name, size).distinct()
    number = F.row_number().over(Window.partitionBy(folder, name).orderBy(size))
    return distinct.withColumn("stored_as", F.when(number == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_alt"), number)))
