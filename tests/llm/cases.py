"""Small tables with the awkward cases, and brute-force versions to test against."""

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, cls string, salt int, set string"


def words(text):
    return WORD.findall(text or "")


def corpus(seed=1, n=60):
    """Rows with copies, near copies, nulls, blanks, odd characters, one very long text and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghéü") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 120))) for _ in range(n)]
    for i in range(0, n, 3):
        own = texts[i].split()
        own[len(own) // 2] = "changed"
        texts += [texts[i], " ".join(own), texts[i].upper()]
    texts += [None, "", " \n\t", "one", "two words", "One", "a b c", "a b c d", "\x1c\x85 x", "漢字 " * 30, "x" * 5000]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(30_000)))
    texts.append("same line here\n" * 40)
    rows = [(i, t, "en", "src", len(t or ""), 0.5, "k", 1, "z") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[5], (None, texts[1], None, None, None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)


def counts(text):
    """The base counts of the quality rules."""
    found = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = set()
    for i in range(len(found) - 7):
        if windows[tuple(found[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def shingles(text):
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if len(found) < 3:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(zip(found, found[1:], found[2:]))


def components(rows):
    """(n_shingles, component) of each row by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), r[0]), r[0])
    return [(r[0], len(s), r[0] if not s else smallest.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))]


def representatives(rows):
    """Ids of the rows that stay when one of each component does; rows without a set all stay."""
    sets = [shingles(r[1]) for r in rows]
    kept, seen = [r[0] for r, s in zip(rows, sets) if not s], set()
    root = {}
    for i, s in enumerate(sets):
        if s:
            linked = {root[j] for j in root if 100 * len(s & sets[j]) >= 90 * len(s | sets[j])}
            root[i] = i
            for j in root:
                if root[j] in linked:
                    root[j] = i
    for i in sorted(root, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        if root[i] not in seen:
            seen.add(root[i])
            kept.append(rows[i][0])
    return kept
