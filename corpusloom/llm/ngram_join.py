"""N-gram Jaccard join with skipping by set relations.

A document's set holds its distinct shingles, of ``SHINGLE`` words unless the caller says otherwise. Two documents link
when the Jaccard similarity of their sets is at least ``PERCENT`` % (or the caller's); the result gives each document's
component, so pairs inside what is already one component are never formed.

* Equal sets are one class; everything below works on classes.
* Answers from similar sets: classes that agree in a band of minimum hashes meet with a few leaders of their bucket. A
  class that links with a leader takes over the leader's component, so what the leader finds holds for the class too.
* Parity bitmaps: each set has a bitmap with the parity of its shingles' low hash bits. Two bitmaps differ in no more
  bits than the sets do in shingles, so pairs whose bitmaps differ too much are dropped without their sets.
* Index lists: the prefix of a class under one global order (hash order, with shingles that many documents share last)
  must share a shingle with that of any class it links with. Lists hold one entry for each component and size block;
  blocks whose sizes or positions can't reach the needed overlap are skipped, and only entries of different components
  meet. The pairs they leave are compared exactly.
* Links become components by FastSV label propagation; each round is written to the shared folder.
* Where a leader, hub or root has a large part of the rows of a join, its rows are dealt over salts.

The order of the prefix and the buckets only steer the work: the result is that of comparing all pairs, but for hash
collisions (64 bits for a shingle within a pair, 128 for a class).

Edge cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text with fewer words than a shingle has its whole
sequence as one shingle; null and blank texts have an empty set, link with nothing and are their own component. A null
id counts only where no linked row has an id. Repeated rows are equal sets; rows that share an id but not the text are
told apart by their sets. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import Words, mix, text_slices
from corpusloom.llm.shared import dropped_at_end, hot_keys, modest_batches, salt, spread_join, staged, unused

SHINGLE = 3
PERCENT = 90
BANDS, HASHES_A_BAND, LEADERS = 3, 3, 12
COMMON_SHARE, COMMON_LEAST, COMMON_MOST = 0.0003, 3, 200_000
LONG_LIST = 8
LARGE_BUCKET = 8
BROADCAST_IDS = 2_000_000
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, BANDS * HASHES_A_BAND, dtype=np.uint64) | np.uint64(1)


class Rule(NamedTuple):
    """When texts link: words of a shingle, and the least Jaccard similarity in percent."""

    shingle: int = SHINGLE
    percent: int = PERCENT

    @property
    def block_ratio(self) -> float:
        """Over 100 / percent, so that sizes that can link are in the same or the next block."""
        return 1.008 * 100 / self.percent


def slice_sets(raw: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of rows, hashes) of the sorted distinct shingles of each row of a slice."""
    words = Words(raw, offsets, lower=True)
    hashes = words.hashes
    first, grams = words.ngrams(hashes, n)
    rows = [words.row[first]]
    keys = [grams]
    for k in range(1, n):
        short = np.flatnonzero(words.counts == k)
        at = words.bounds[short]
        key = np.full(len(short), 0xD6E8FEB86659FD93 + k, np.uint64)
        for j in range(k):
            key = mix(key * np.uint64(0xA24BAED4963EE407) + hashes[at + j])
        rows.append(short)
        keys.append(key)
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    row, key = row[new], key[new]
    return np.searchsorted(row, np.arange(len(offsets))), key


def _binaries(table: np.ndarray) -> pa.Array:
    """The rows of a contiguous array as binary values."""
    size = table.dtype.itemsize * (table.shape[1] if table.ndim > 1 else 1)
    offsets = np.arange(len(table) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(table), [None, pa.py_buffer(offsets), pa.py_buffer(table.tobytes())])


def fingerprints(bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Two 64-bit sums for each row's set."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    for j, seed in enumerate((0x2545F4914F6CDD1D, 0x9E6C63D0876A9A35)):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(keys ^ np.uint64(seed)), dtype=np.uint64)))
        out[:, j] = mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return out


def band_keys(bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A key for each row and band from the band's minimum hashes; rows without a set get 0."""
    out = np.zeros((len(bounds) - 1, BANDS), np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        for band in range(BANDS):
            key = np.full(len(full), band + 1, np.uint64)
            for j in range(HASHES_A_BAND):
                low = np.minimum.reduceat(keys * _MULTIPLIERS[band * HASHES_A_BAND + j], bounds[:-1][full])
                key = mix(key * np.uint64(0x9FB21C651E98DF25) + low)
            out[full, band] = key
    return out


def bitmaps(bounds: np.ndarray, keys: np.ndarray) -> pa.Array:
    """Parity bitmaps as binary values; a set of n shingles has the power of two from n on, 64 at least, of bits."""
    n = np.diff(bounds)
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    start = np.concatenate(([0], np.cumsum(bits)))
    row = np.repeat(np.arange(len(n)), n)
    at = start[row] + (keys & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(at, minlength=start[-1]) & 1).astype(np.uint8)
    raw = np.packbits(odd, bitorder="little")
    offsets = pa.py_buffer((start // 8).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(n), [None, offsets, pa.py_buffer(raw.tobytes())])


def map_difference(map1: bytes, map2: bytes) -> int:
    """A lower bound on how many shingles are in just one of two sets; the longer map is folded onto the shorter."""
    x, y = np.frombuffer(map1, np.uint64), np.frombuffer(map2, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(n1: int, map1: bytes, n2: int, map2: bytes, percent: int = PERCENT) -> bool:
    """Whether sizes and bitmaps leave room for a link: linked sets differ in (n1 + n2) / 19 shingles at most for 90 %."""
    if 100 * min(n1, n2) < percent * max(n1, n2):
        return False
    return (100 + percent) * map_difference(map1, map2) <= (100 - percent) * (n1 + n2)


def groups_may_link(
    n1: int, map1: bytes, many1: bool, n2: int, map2: bytes, many2: bool, percent: int = PERCENT
) -> bool:
    """Whether some members of two groups may link, by their leaders' sizes and bitmaps.

    At 90 %, with a leader of n shingles, a member s has up to n / 0.9 and differs from it in (n + s) / 19 at most. By the
    triangle inequality the leaders then differ in (n + 2 s) / 19 for either side; for a lone class that is n / 19.
    """
    reach = sum(n * (100 + 2 * 10_000 / percent if many else 100) for n, many in ((n1, many1), (n2, many2))) / 100
    return (100 + percent) * map_difference(map1, map2) <= (100 - percent) * reach + 1e-6


SIGNATURE = (
    "print long, n_shingles long, cls binary, half long, bands array<long>, bitmap binary, "
    "common array<struct<shingle: long, n: int>>"
)


def signatures(docs: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """(id, print, n_shingles, cls, half, bands, bitmap, common) of every row.

    ``print`` is a hash of the text as it is, ``half`` is half of ``cls``; ``common`` is filled in one row of each batch:
    shingles that are in many of its rows, with their counts.
    """
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(SIGNATURE).fields])
    pair = pa.struct([("shingle", pa.int64()), ("n", pa.int32())])
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pair)]
    names = ["print", "n_shingles", "cls", "half", "bands", "bitmap", "common"]

    def run(batches):
        for batch in batches:
            parts, counted = [], []
            for lo, hi, raw, offsets in text_slices(batch.column(1)):
                bounds, keys = slice_sets(raw, offsets, rule.shingle)
                counted.append(keys)
                prints = fingerprints(bounds, keys)
                parts.append((lo, hi, np.diff(bounds), prints, band_keys(bounds, keys), bitmaps(bounds, keys)))
            shingles = np.sort(np.concatenate(counted)) if counted else np.zeros(0, np.uint64)
            edge = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1]))) if len(shingles) else shingles
            size = np.diff(np.append(edge, len(shingles))).astype(np.int64)
            often = np.flatnonzero(size >= max(COMMON_LEAST, COMMON_SHARE * batch.num_rows))
            common = [{"shingle": int(s), "n": int(c)} for s, c in zip(
                shingles[edge[often].astype(np.int64)].view(np.int64), size[often], strict=True)]
            for lo, hi, n, prints, bands, maps in parts:
                columns = [
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n.astype(np.int64)), _binaries(prints),
                    pa.array(prints[:, 0].copy().view(np.int64)), pa.array(list(bands.view(np.int64)), kinds[2]), maps,
                    pa.array([common if lo == 0 and not i else [] for i in range(hi - lo)], kinds[3]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [id_col, *names])

    return docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col)).mapInArrow(run, schema)


def text_sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """(cls, set) of the given classes (cls, min_id), from the texts of rows with their smallest id."""
    wanted = classes.select(F.col("min_id").alias("_wanted")).distinct()
    wanted = _within(wanted)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi")

    def run(batches):
        for batch in batches:
            for _, _, raw, offsets in text_slices(batch.column(0)):
                bounds, keys = slice_sets(raw, offsets, rule.shingle)
                at = pa.py_buffer((8 * bounds).astype(np.int32))
                sets = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, at, pa.py_buffer(keys.tobytes())])
                yield pa.RecordBatch.from_arrays([_binaries(fingerprints(bounds, keys)), sets], ["cls", "set"])

    made = rows.select("_text").mapInArrow(run, "cls binary, set binary")
    return made.join(classes.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets link, by integer arithmetic."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def consensus_distance(rows: DataFrame, large: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, bucket, far): how far a class' bitmap is from the bitwise majority of its bucket, for large buckets.

    Copies that differ from a common origin each in their own way agree on its bits, so the nearest class is the origin
    or closest to it, and links with more of the others than any of them. Sums are made by bucket and salt first.
    """
    maps = classes.select("cls", "bitmap")
    members = staged(rows.join(large, ["bucket", "salt"]), "voters")
    dealt = members.join(maps, "cls").repartition("bucket", "salt").sortWithinPartitions("bucket", "salt")

    def add(batches):
        here, sums = None, {}

        def close():
            names = ["bucket", "size", "n", "ones"]
            rows = [(here[0], size, n, ones.astype(np.int32).tobytes()) for size, (n, ones) in sums.items()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds, strict=True)], names)

        for batch in batches:
            for bucket, salt_, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, salt_) != here:
                    if sums:
                        yield close()
                    here, sums = (bucket, salt_), {}
                n, ones = sums.get(len(bits), (0, 0))
                sums[len(bits)] = n + 1, ones + np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(np.int64)
        if sums:
            yield close()

    votes = dealt.select("bucket", "salt", "bitmap").mapInArrow(add, "bucket long, size int, n int, ones binary")

    def majority(batches):
        for batch in batches:
            out = []
            for parts in batch.column(1).to_pylist():
                by_size: dict[int, list] = {}
                for p in parts:
                    by_size.setdefault(p["size"], []).append(p)
                best = max(by_size.values(), key=lambda own: sum(p["n"] for p in own))
                ones = sum(np.frombuffer(p["ones"], np.int32).astype(np.int64) for p in best)
                out.append(np.packbits(2 * ones > sum(p["n"] for p in best), bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["bucket", "middle"])

    # at most a row for each salt and size comes together here
    middles = votes.groupBy("bucket").agg(F.collect_list(F.struct("size", "n", "ones")).alias("parts"))
    middles = middles.mapInArrow(majority, "bucket long, middle binary")
    placed = members.join(large.join(middles, "bucket"), ["bucket", "salt"]).join(maps, "cls")

    def measure(batches):
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            far = pa.array([map_difference(a, b) for a, b in pairs], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), far], ["cls", "bucket", "far"])

    return placed.select("cls", "bucket", "bitmap", "middle").mapInArrow(measure, "cls binary, bucket long, far int")


def leader_pairs(classes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): a class and the first leader of its bucket that it may link with; leaders meet every other leader.

    Rows of a bucket are dealt out by a salt and leaders are copied to each of its salts, so a hot bucket is spread; a
    task holds only the leaders' bitmaps and streams the others past them. Every bucket prefers leaders by the same
    hashes, so the buckets of one group of copies mostly share their leaders.
    """
    rows = classes.filter("n_shingles > 0").select("cls", F.explode("bands").alias("bucket"))
    rows = rows.withColumn("salt", salt(F.col("cls")))
    part = rows.groupBy("bucket", "salt").agg(F.count("*").alias("n"))
    whole = part.groupBy("bucket").agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).filter("n > 1")
    whole = staged(whole, "whole-buckets")
    buckets = whole.select("bucket", F.explode("salts").alias("salt"))
    large = staged(whole.filter(F.col("n") >= LARGE_BUCKET).select("bucket", F.explode("salts").alias("salt")), "large")
    far = consensus_distance(rows, large, classes)
    # Spark cuts each task's rows to the first ranks of a bucket before they move
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.coalesce("far", F.lit(0)), F.xxhash64("cls"), "cls"))
    near = rows.join(far, ["cls", "bucket"], "left").select("bucket", "cls", "far")
    first = near.withColumn("role", rank - 1).filter(F.col("role") < LEADERS)
    leaders = first.join(buckets, "bucket").select("cls", "bucket", "salt", "role")
    members = rows.join(buckets.select("bucket", "salt"), ["bucket", "salt"]).withColumn("role", F.lit(LEADERS))
    meeting = members.select("cls", "bucket", "salt", "role").unionByName(leaders)
    meeting = staged(meeting, "meetings").join(classes.select("cls", "n_shingles", "bitmap"), "cls")
    dealt = meeting.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "role")

    def run(batches):
        here, leaders = None, {}
        for batch in batches:
            a, b = [], []
            for cls, bucket, salt_, role, n, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, salt_) != here:
                    here, leaders = (bucket, salt_), {}
                if role < LEADERS:
                    leaders[cls] = (n, bits)
                    continue
                for name, (n2, bits2) in leaders.items():
                    if name != cls and may_link(n, bits, n2, bits2, rule.percent):
                        a.append(cls)
                        b.append(name)
                        if cls not in leaders:
                            break
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    dealt = dealt.select("cls", "bucket", "salt", "role", "n_shingles", "bitmap")
    return staged(dealt.mapInArrow(run, "a binary, b binary").distinct(), "leader-pairs")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component, by FastSV; every round is written out.

    Joins on a hub or a root, which a large part of all nodes may share, are dealt over salts.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(both.filter("a <> b").distinct(), "edges")
    hubs = hot_keys(edges, ["b"])
    start = edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("f"))
    state = staged(_grand(staged(start, "labels")), "labels")
    while True:
        ends = spread_join(edges, state.select(F.col("node").alias("b"), "gf"), ["b"], F.col("a"), hubs)
        far = ends.groupBy("a").agg(F.min("gf").alias("m"))
        seen = staged(state.join(far, F.col("node") == F.col("a")).select("node", "f", "gf", "m"), "hooks")
        hooks = seen.select("node", F.least("f", "gf", "m").alias("f")).unionByName(
            seen.select(F.col("f").alias("node"), F.least("gf", "m").alias("f"))
        )
        new = staged(_grand(staged(hooks.groupBy("node").agg(F.min("f").alias("f")), "labels")), "labels")
        changed = new.join(state.select("node", F.col("gf").alias("old")), "node").filter("gf <> old").limit(1).count()
        state = new
        if not changed:
            return state.select("node", F.col("gf").alias("root"))


def _grand(labels: DataFrame) -> DataFrame:
    """Labels of the labels, which must be a staged table."""
    upper = labels.select(F.col("node").alias("f"), F.col("f").alias("gf"))
    return spread_join(labels, upper, ["f"], F.col("node"), hot_keys(labels, ["f"])).select("node", "f", "gf")


def prefix_rows(docs: DataFrame, text_col: str, common: np.ndarray, rule: Rule) -> DataFrame:
    """(shingle, half, n, pos): the prefix of every text's set. ``common``: shingles that come last, rarest first."""
    by_hash = np.argsort(common)
    table, rank = common[by_hash], by_hash
    bitmap = np.zeros(1 << 20, bool)
    bitmap[(table & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def order(bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, position in the global order) of each shingle."""
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        late = bitmap[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)]
        maybe = np.flatnonzero(late)
        at = np.searchsorted(table, keys[maybe])
        real = at < len(table)
        real[real] = table[at[real]] == keys[maybe][real]
        late[maybe[~real]] = False
        early = np.concatenate(([0], np.cumsum(~late)))
        pos = early[:-1] - early[bounds[row]]
        hit, place = maybe[real], rank[at[real]]
        by = np.lexsort((place, row[hit]))
        hit = hit[by]
        group = row[hit]
        first = np.searchsorted(group, group)
        pos[hit] = early[bounds[group + 1]] - early[bounds[group]] + np.arange(len(hit)) - first
        return row, pos

    def run(batches):
        for batch in batches:
            done = set()
            for _, _, raw, offsets in text_slices(batch.column(0)):
                bounds, keys = slice_sets(raw, offsets, rule.shingle)
                prints = fingerprints(bounds, keys)
                row, pos = order(bounds, keys)
                n = np.diff(bounds)
                length = n - (rule.percent * n + 99) // 100 + 1
                fresh = np.zeros(len(n), bool)
                for i, key in enumerate(map(bytes, prints)):
                    if key not in done:
                        done.add(key)
                        fresh[i] = True
                keep = np.flatnonzero((pos < length[row]) & fresh[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[keep].view(np.int64)), pa.array(prints[row[keep], 0].view(np.int64)), pa.array(n[row[keep]].astype(np.int32)),
                        pa.array(pos[keep].astype(np.int32)),
                    ],
                    ["shingle", "half", "n", "pos"],
                )

    return docs.select(F.col(text_col)).mapInArrow(run, "shingle long, half long, n int, pos int")


def common_shingles(docs: DataFrame, rows: DataFrame, text_col: str, rule: Rule) -> np.ndarray:
    """Shingles that the prefix order puts last, rarest first: the most frequent ones, ``COMMON_MOST`` at most.

    Counts within batches find the most common ones; a first prefix under that order shows which lists are long still.
    This only steers the work, so the bound on what is collected loses no link.
    """
    top = [F.desc("n"), F.col("shingle")]
    seen = rows.select(F.explode("common").alias("x")).groupBy("x.shingle").agg(F.sum("x.n").alias("n"))
    often = seen.orderBy(*top).limit(COMMON_MOST).collect()
    found = {r["shingle"]: r["n"] for r in often}
    first = np.array(sorted(found, key=lambda k: (found[k], k)), np.int64).view(np.uint64)
    lists = prefix_rows(docs, text_col, first, rule).groupBy("shingle").agg(F.count("*").alias("n"))
    for r in lists.filter(F.col("n") >= LONG_LIST).orderBy(*top).limit(COMMON_MOST).collect():
        found[r["shingle"]] = max(found.get(r["shingle"], 0), r["n"])
    kept = sorted(found, key=lambda k: (-found[k], k))[:COMMON_MOST]
    return np.array(kept[::-1], np.int64).view(np.uint64)


def _needed(n1: Column, n2: Column, percent: int) -> Column:
    """Smallest intersection with which sets of these sizes link."""
    return F.ceil(percent * (n1 + n2) / (100 + percent) - 1e-9)


def group_pairs(
    prefixes: DataFrame, classes: DataFrame, led: DataFrame, roots: DataFrame, rule: Rule
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Pairs of groups of different components that may have a link between them, by the index lists.

    A class that links with a leader stands in the lists under its leader (its group). Sets that link differ in few
    shingles, so the leaders of two groups with a link between them differ in few, too: bitmaps of the leaders drop
    pairs of groups before their members are looked at.

    Returns (ga, gb, direct, leaders): pairs, whether both are lone classes, whether the leaders themselves may link;
    (shingle, ga, gb): the lists they met in; the list entries of all classes; sizes and bitmaps.
    """
    # lists with one class only are dropped first; both sums are made before rows move
    live = prefixes.groupBy("shingle").agg(F.min("half").alias("lo"), F.max("half").alias("hi")).filter("lo <> hi")
    live = staged(live.select("shingle"), "live")
    leaders = led.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("grp"))
    known = classes.select("cls", "half").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    known = known.join(leaders, "cls", "left").select(
        "half", "cls", F.coalesce("root", "cls").alias("root"), F.coalesce("grp", "cls").alias("grp")
    )
    entries = prefixes.join(live.hint("shuffle_hash"), "shingle").join(staged(known, "known"), "half")
    entries = staged(entries.select("shingle", "cls", "grp", "root", "n", (F.col("n") - F.col("pos")).alias("rest")), "entries")
    block = F.floor(F.log(F.col("n").cast("double")) / np.log(rule.block_ratio)).cast("int")
    lists = entries.groupBy("shingle", "grp", "root", block.alias("block")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest")
    )
    lists = staged(lists, "lists")
    several = lists.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    lists = lists.join(staged(several.select("shingle"), "several").hint("shuffle_hash"), "shingle")
    left = lists.select(
        "shingle", F.col("grp").alias("ga"), F.col("root").alias("ra"), F.col("block").alias("ba"),
        F.col("least").alias("la"), F.col("most").alias("ma"), F.col("rest").alias("sa"),
        F.explode(F.array("block", F.col("block") + 1)).alias("block"),
    )
    met = left.join(lists, ["shingle", "block"]).filter(
        (F.col("ra") != F.col("root"))
        & ((F.col("ba") < F.col("block")) | (F.col("ga") < F.col("grp")))
        & (100 * F.col("most") >= rule.percent * F.col("la"))
        & (100 * F.col("ma") >= rule.percent * F.col("least"))
        & (F.least("sa", "rest") >= _needed(F.col("la"), F.col("least"), rule.percent))
    )
    met = met.select("shingle", F.least("ga", "grp").alias("ga"), F.greatest("ga", "grp").alias("gb"))
    met = staged(met, "met")
    centres = led.select(F.col("b").alias("cls"), F.lit(True).alias("centre")).distinct()
    sizes = staged(classes.select("cls", "n_shingles", "bitmap").join(centres, "cls", "left").fillna(False, "centre"), "sizes")
    side = lambda g, n: sizes.toDF(g, *(f"{c}_{n}" for c in ("n", "map", "centre")))
    near = met.select("ga", "gb").distinct().join(side("ga", "a"), "ga").join(side("gb", "b"), "gb")
    near = near.select("ga", "gb", "n_a", "map_a", "centre_a", "n_b", "map_b", "centre_b")
    def prune(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[2:]]
            keep = pa.array([groups_may_link(*x, rule.percent) for x in zip(*columns, strict=True)], pa.bool_())
            direct = [not (x or y) for x, y in zip(columns[2], columns[5], strict=True)]
            n1, map1, _, n2, map2, _ = columns
            leaders = [may_link(*x, rule.percent) for x in zip(n1, map1, n2, map2, strict=True)]
            flags = [pa.array(direct, pa.bool_()), pa.array(leaders, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *flags], ["ga", "gb", "direct", "leaders"]).filter(keep)

    near = near.mapInArrow(prune, "ga binary, gb binary, direct boolean, leaders boolean")
    return staged(near, "near-groups"), met, entries, sizes


def member_pairs(near: DataFrame, met: DataFrame, entries: DataFrame, sizes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): members of the given pairs of groups that share a list and may link."""
    shared = met.join(near.select("ga", "gb"), ["ga", "gb"], "left_semi")
    end = lambda g, n: entries.select("shingle", *(F.col(x).alias(y) for x, y in (
        ("grp", g), ("cls", n), ("n", f"n{n}"), ("rest", f"r{n}"))))
    members = hot_keys(entries, ["shingle", "grp"])
    first = spread_join(end("ga", "a"), shared, ["shingle", "ga"], F.col("a"), members)
    found = spread_join(first, end("gb", "b"), ["shingle", "gb"], F.col("a"), members).filter(
        (100 * F.col("na") >= rule.percent * F.col("nb"))
        & (100 * F.col("nb") >= rule.percent * F.col("na"))
        & (F.least("ra", "rb") >= _needed(F.col("na"), F.col("nb"), rule.percent))
    )
    pairs = staged(found.select("a", "b").distinct(), "near-pairs")
    side = lambda n: sizes.select(F.col("cls").alias(n), F.col("n_shingles").alias(f"n{n}"), F.col("bitmap").alias(f"m{n}"))
    close = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "ma", "nb", "mb")

    def run(batches):
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns[2:])
            keep = [may_link(*pair, rule.percent) for pair in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return staged(close.mapInArrow(run, "a binary, b binary"), "candidates")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """The given pairs (a staged table) that link, by their whole sets; pairs with a class that is in many are dealt out."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    needed = ends.join(classes, "cls").select("cls", "min_id")
    sets = staged(text_sets(docs, needed, id_col, text_col, rule), "sets")
    side = lambda n: sets.select(F.col("cls").alias(n), F.col("set").alias(f"s{n}"))
    rows = spread_join(pairs, side("a"), ["a"], F.col("b"), hot_keys(pairs, ["a"]))
    rows = spread_join(rows, side("b"), ["b"], F.col("a"), hot_keys(pairs, ["b"])).select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), rule.percent)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    return staged(rows.mapInArrow(run, "a binary, b binary"), "links")


def found_roots(
    docs: DataFrame, classes: DataFrame, rows: DataFrame, id_col: str, text_col: str, rule: Rule
) -> DataFrame:
    """(node, root) of the classes with a link: leaders first, then pairs of leaders that the lists give, then members of
    groups that aren't in one component by then."""
    edges = lambda known, more: known.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    led = verified(docs, leader_pairs(classes, rule), classes, id_col, text_col, rule)
    roots = components(led)
    prefixes = staged(prefix_rows(docs, text_col, common_shingles(docs, rows, text_col, rule), rule), "prefixes")
    near, met, entries, sizes = group_pairs(prefixes, classes, led, roots, rule)
    pairs = staged(near.filter("leaders").select(F.col("ga").alias("a"), F.col("gb").alias("b")), "leaders")
    more = verified(docs, pairs, classes, id_col, text_col, rule)
    roots = components(edges(roots, more))
    side = lambda g, r: roots.select(F.col("node").alias(g), F.col("root").alias(r))
    apart = near.filter("not direct").join(side("ga", "ra"), "ga", "left").join(side("gb", "rb"), "gb", "left")
    apart = staged(apart.filter(F.coalesce("ra", "ga") != F.coalesce("rb", "gb")), "apart")
    last = verified(docs, member_pairs(apart, met, entries, sizes, rule), classes, id_col, text_col, rule)
    return roots if last.isEmpty() else components(edges(roots, last))


def component_rows(docs: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """(id, print, n_shingles, component, component_id) of every row; ``component`` is null for rows without a set."""
    spark = docs.sparkSession
    modest_batches(spark)
    with dropped_at_end(spark, but=("signatures", "named")):
        rows = staged(signatures(docs, id_col, text_col, rule), "signatures")
        own = rows.select(F.col(id_col).alias("_id"), "print", "n_shingles", "cls", "half", "bands", "bitmap")
        first = [F.first(c).alias(c) for c in ("n_shingles", "half", "bands", "bitmap")]
        classes = own.filter("n_shingles > 0").groupBy("cls").agg(F.min("_id").alias("min_id"), *first)
        classes = staged(classes, "classes")
        roots = staged(found_roots(docs, classes, rows, id_col, text_col, rule), "roots")
        smallest = roots.join(classes.select(F.col("cls").alias("node"), "min_id"), "node")
        smallest = smallest.groupBy("root").agg(F.min("min_id").alias("component_id"))
        known = spread_join(roots, smallest, ["root"], F.col("node"), hot_keys(roots, ["root"]))
        named = classes.select("cls", "min_id").join(known.withColumnRenamed("node", "cls"), "cls", "left")
        named = named.select(
            "cls", F.coalesce("root", "cls").alias("component"),
            F.when(F.col("root").isNull(), F.col("min_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        named = staged(named, "named")
    # a class' rows are met by class and salt, so that copies of one text spread
    salted = own.select("_id", "print", "n_shingles", "cls", salt(F.col("_id")).alias("salt"))
    meeting = salted.filter("n_shingles > 0").select("cls", "salt").distinct().join(named, "cls")
    out = salted.join(meeting, ["cls", "salt"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), "print", "n_shingles", "component", component.alias("component_id"))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    return component_rows(docs, id_col, text_col, Rule(shingle, percent)).select(id_col, "n_shingles", "component_id")


def keep_representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of each component: that with the smallest id, then hash of its text; a null id is the largest.

    Rows without a set all stay. Decisions are by row, so rows that share an id but not the text don't share a fate.
    """
    with dropped_at_end(docs.sparkSession, but=("lost", "again")):
        found = component_rows(docs, id_col, text_col, Rule(shingle, percent)).filter("n_shingles > 0")
        found = staged(found.select(F.col(id_col).alias("id"), "print", "component"), "components")
        order = F.struct(F.col("id").isNull().alias("none"), "id", "print")
        chosen = found.groupBy("component").agg(F.min(order).alias("row")).select("row.id", "row.print")
        chosen = chosen.withColumn("stays", F.lit(True))
        counted = found.groupBy("id", "print").agg(F.count("*").alias("rows")).alias("c").join(
            chosen.alias("s"), F.col("c.id").eqNullSafe(F.col("s.id")) & (F.col("c.print") == F.col("s.print")), "left"
        ).select("c.id", "c.print", "rows", "stays")
        counted = staged(counted, "counted")
        lost = staged(counted.filter("stays is null").select("id", "print"), "lost")
        again = staged(counted.filter("stays and rows > 1").select("id", "print"), "again")
    by_id, by_print = unused("ngram_id", docs), unused("ngram_print", docs)

    def meet(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        same = F.col(id_col).eqNullSafe(F.col(by_id)) & (F.xxhash64(text_col) == F.col(by_print))
        return rows.join(_within(ids.toDF(by_id, by_print)), same, how)

    rows = meet(docs, lost, "left_anti")
    if again.isEmpty():
        return rows
    one = [F.first(F.struct(*(F.col(c) for c in docs.columns))).alias("row")]
    single = meet(rows, again, "left_semi").groupBy(F.col(id_col).alias(by_id), F.xxhash64(text_col).alias(by_print)).agg(*one)
    return meet(rows, again, "left_anti").unionByName(single.select("row.*"))


def _within(ids: DataFrame) -> DataFrame:
    """Broadcast ids behind a check of their number; hash them by partition beyond it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
