import hashlib
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tallyline.llm.merkle import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def climbed(level, place):
    """(root, siblings, sides) of one place, with all levels built."""
    siblings = []
    while len(level) > 1:
        other = place ^ 1
        if other < len(level):
            siblings.append((level[other], other < place))
        else:
            siblings.append(("", False))
        level = [sha(*level[i:i + 2]) for i in range(0, len(level), 2)]
        place //= 2
    return level[0], siblings


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: sorted(((r["doc_id"] is not None, r["doc_id"] or 0), leaf_of(r), n) for n, r in enumerate(groups[g])) for g in order}
    subroots = [climbed([x[1] for x in leaves[g]], 0)[0] for g in order]
    found = []
    for at, g in enumerate(order):
        root, above = climbed(subroots, at)
        level = [x[1] for x in leaves[g]]
        for place, (_, leaf, n) in enumerate(leaves[g]):
            row = groups[g][n]
            siblings = climbed(level, place)[1] + above
            folded = leaf
            if row["doc_id"] is not None and crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None:
                folded = leaf_of(row | {"n_chars": row["n_chars"] + 1})
            for sibling, before in siblings:
                folded = sha(sibling, folded) if before else sha(folded, sibling)
            found.append((row["doc_id"], leaf, subroots[at], root, sha(*[s for s, _ in siblings]), folded, folded == root))
    return found


def run(spark, rows):
    docs = spark.createDataFrame([tuple(r[f] for f in FIELDS) + ("own", 5) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, idx string, hash int")
    made = manifest(docs, F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 0)
    return [tuple(r) for r in made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def rows_of(sizes):
    made = []
    for lang, n in sizes.items():
        made += [{"doc_id": 3 * i + len(made) % 2, "source": "s", "lang": lang, "n_chars": i if i % 5 else None, "text": f"é{i}"} for i in range(n)]
    return made


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 2}, {"a": 1, "b": 1, "c": 3}, {None: 5, "": 2, "é": 7, "z": 1},
    {"a": 1024}, {"a": 1025, None: 3}, {"a": 2100, "b": 1023, "c": 6},
])
def test_manifest_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    assert sorted(run(spark, rows), key=str) == sorted(brute(rows), key=str)


def test_manifest_of_odd_rows(spark):
    odd = [{"doc_id": d, "source": s, "lang": g, "n_chars": n, "text": t} for d, s, g, n, t in [
        (None, None, None, None, None), (None, "x", "en", 4, ""), (7, "x", "en", 4, "w " * 50_000), (7, "x", "en", 4, "other"),
        (7, "x", "en", 4, "other"), (-3, "", "", 0, "-"), (14, "x", "en", None, "5:other"), (2, None, "en", 1, "日本 😀")]]
    assert sorted(run(spark, odd), key=str) == sorted(brute(odd), key=str)
    assert run(spark, []) == []


def test_tampering_is_found_where_it_is(spark):
    rows = [r | {"n_chars": 4} for r in rows_of({"a": 300, "b": 40})]
    for row in run(spark, rows):
        assert row[6] is (crc32(str(row[0]).encode()) % 7 != 0)
