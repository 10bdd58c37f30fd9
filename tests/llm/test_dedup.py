import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.llm.embedding_dedup import _compared, near_vectors
from tallyline.llm.line_dedup import _units, dedup_lines, repeated_units
from tallyline.llm.minhash_dedup import keep_first_of_group, near_duplicates

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Groups(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near(rows):
    sets, groups = {k: shingles(t) for k, t in rows}, Groups()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {k: (len(sets[k]), groups.root(k), groups.root(k) == k) for k in keys}


def copies_with_changes(seed, groups, most):
    rnd = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{n}" for n in rnd.integers(0, 5000, rnd.integers(3, 200))]
        for _ in range(rnd.integers(1, most)):
            own = list(words)
            for at in np.flatnonzero(rnd.random(len(own)) < rnd.choice([0, 0.01, 0.04])):
                own[at] = f"x{rnd.integers(0, 9999)}"
            rows.append(" ".join(own))
    return [(int(i), t) for i, t in zip(rnd.permutation(10 * len(rows))[:len(rows)], rows)]


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = copies_with_changes(seed, 60, 8)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute_near(rows)


def test_near_duplicates_of_one_large_group(spark):
    """One group holds most rows and its members differ, and all share a passage with the rest."""
    rnd = np.random.default_rng(3)
    base, passage = [f"b{n}" for n in range(150)], [f"p{n}" for n in range(60)]
    rows = []
    for i in range(900):
        own = list(base) if i % 3 else [f"r{n}" for n in rnd.integers(0, 10**6, 50)]
        for at in np.flatnonzero(rnd.random(len(own)) < 0.02):
            own[at] = f"x{rnd.integers(0, 9999)}"
        rows.append((i, " ".join(own + passage)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute_near(rows)


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    found = {r["doc_id"]: r for r in near_duplicates(odd_docs).collect()}
    assert found[6]["component_id"] == 1 and not found[6]["kept"] and found[1]["kept"]
    assert all(found[i]["component_id"] == i and found[i]["n_shingles"] == 0 and found[i]["kept"] for i in (2, 3, 4))
    assert found[None]["component_id"] is None and found[None]["kept"]
    assert found[5]["component_id"] == 5 and not found[10]["kept"] and found[9]["n_shingles"] == 1
    kept = keep_first_of_group(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert near_duplicates(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, n) for n in range(501, 700)] + [(700, 650), (7, 7), (9, 8)]
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[n] for n in range(100, 161)} == {100} and {found[n] for n in range(500, 701)} == {500}
    assert found[9] == found[8] == 8 and 7 not in found
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows, least=0.9):
    units = {}
    for key, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            units[key] = np.array(v) / np.linalg.norm(v)
    links, groups = defaultdict(int), Groups()
    keys = sorted(units)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    return {k: (links[k], groups.root(k), groups.root(k) == k) for k, _ in rows}


def test_near_vectors(spark):
    rnd, rows = np.random.default_rng(2), []
    for _ in range(80):
        centre = rnd.standard_normal(16)
        rows += [(centre + 0.1 * rnd.standard_normal(16)).tolist() for _ in range(rnd.integers(1, 6))]
    centre = rnd.standard_normal(16)
    rows += [(centre + 0.05 * rnd.standard_normal(16)).tolist() for _ in range(1500)]  # more than a block
    rows += [rows[0], rows[0], [0.0] * 16, None, [float("nan")] * 16, [None] * 16, [1.0, 0.0], [1.0, 0.1], [], [1e200] * 16, [1e-200] * 16]
    rows = [(i, v) for i, v in enumerate(rows)]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("mark", F.lit(1)))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    want = brute_vectors([(k, None if v is not None and len(v) == 16 and None not in v and max(map(abs, v)) in (1e200, 1e-200) else v)
                          for k, v in rows])
    huge = [k for k, v in rows if v and v[0] in (1e200, 1e-200)]
    assert {found[k][1] for k in huge} == {min(huge)}  # one direction, whatever the length
    assert {k: v[1:] for k, v in found.items() if k not in huge} == {k: v[1:] for k, v in want.items() if k not in huge}
    counts = np.array([[found[k][0], want[k][0]] for k, _ in rows if k not in huge])
    assert (counts[:, 0] <= counts[:, 1]).all() and counts[:, 0].sum() >= 0.98 * counts[:, 1].sum()
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


@pytest.mark.parametrize("cut", [False, True])
def test_links_of_a_block_pair_are_spanned(cut):
    """Chains whose members each have a lower-numbered neighbour elsewhere: 1-5, 5-6, 6-2, and random graphs."""
    angles = {1: 0, 5: 20, 6: 40, 2: 60, 9: 200}
    cases = [(np.array(list(angles)), np.array([[np.cos(np.radians(a)), np.sin(np.radians(a))] for a in angles.values()]), 0.93)]
    rnd = np.random.default_rng(4)
    for _ in range(20):
        v = rnd.standard_normal((400, 3))
        cases.append((rnd.permutation(10_000)[:400], v / np.linalg.norm(v, axis=1, keepdims=True), 0.995))
    for ids, v, least in cases:
        n, groups = len(ids), Groups()
        left = np.arange(n) % 2 == 0 if cut else np.ones(n, bool)
        links = [(i, j) for i, j in zip(*np.nonzero(v @ v.T >= least)) if i < j and (not cut or left[i] != left[j])]
        for i, j in links:
            groups.join(int(ids[i]), int(ids[j]))
        counts, root = _compared(left, v, np.zeros((n, 1), np.int32), 0, np.ones(n, np.int64), ids, least, cut)
        assert root.tolist() == [groups.root(int(i)) for i in ids]
        assert counts.tolist() == np.bincount(np.ravel(links), minlength=n).tolist()


def test_near_vectors_of_loose_groups(spark):
    """Members around a centre of which most pairs are below the least cosine: groups hold by chains."""
    rnd, rows = np.random.default_rng(6), []
    for _ in range(100):
        centre = rnd.standard_normal(64)
        rows += list(centre / np.linalg.norm(centre) + 0.37 * rnd.standard_normal((20, 64)) / 8)
    rows = [(int(i), v.tolist()) for i, v in zip(rnd.permutation(len(rows)), rows)]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    groups = Groups()
    for i, j in zip(*np.nonzero(x @ x.T >= 0.9)):
        groups.join(rows[i][0], rows[j][0])
    assert {r["vec_id"]: r["component_id"] for r in found} == {k: groups.root(k) for k, _ in rows}


def test_line_dedup_deletes_later_runs(spark):
    long_line = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\n b \nc\n\nd\ny"), (3, "a\nb"), (4, f"q\n{long_line}\nr"), (5, f"{long_line}"),
        (6, "s\ns\ns\ns\ns\ns\ns"), (7, None), (8, ""), (None, "a\nb\nc\nd"), (9, "a\nb\nc\nd\ne"), (10, "u\nv\nw"), (10, "u\nv\nw"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("kept"))
    cleaned = dedup_lines(docs)
    assert cleaned.columns == docs.columns
    found = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert found == {1: "a\nb\nc\nd", 2: "x\ny", 3: "a\nb", 4: f"q\n{long_line}\nr", 5: "", 6: "s\ns\ns", 7: None, 8: "",
                     None: "a\nb\nc\nd", 9: "e", 10: "u\nv\nw"}
    assert {(r["id"], r["source_id"]) for r in repeated_units(docs).collect()} == {(2, 1), (5, 4), (6, 6), (9, 1)}
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_lines(rows):
    """Texts after deletion: a run of equal lines that stood earlier goes if it has three lines or 50 words."""
    kept = [(key, [(n, line.strip()) for n, line in enumerate(text.split("\n")) if line.strip()]) for key, text in sorted(rows)]
    first, gone = {}, defaultdict(set)
    for key, lines in kept:
        for size in range(1, 6):
            for i in range(len(lines) - size + 1):
                run = tuple(line for _, line in lines[i:i + size])
                if size < 3 and sum(len(line.split()) for line in run) < 50:
                    continue
                where = first.setdefault(run, (key, i))
                if where[0] != key or i >= where[1] + size:
                    gone[key] |= set(range(lines[i][0], lines[i + size - 1][0] + 1))
    return {key: "\n".join(line for n, line in enumerate(text.split("\n")) if n not in gone[key]) for key, text in rows}


def test_line_dedup_equals_the_rule_on_whole_runs(spark):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    a, b, short = words("a", 34), words("b", 33), words("s", 15)
    rows = [(1, f"x\n{a}\n{b}\ny"), (2, f"{a}\n \n{b}"), (3, f"p\n{a}\n{b}"), (4, a), (5, f"{short}\n{a}"), (6, f"{short}\n{a}\nz"),
            (7, f"{short}\n{b}"), (8, f"{words('l', 60)}\nend"), (9, f"begin\n{words('l', 60)}\nend"), (10, f"{a}\n{b}\n{a}\n{b}\n{a}")]
    rnd = np.random.default_rng(9)
    lines = [words(c, int(n)) for c, n in zip("cdefghijk", rnd.integers(1, 60, 9))]
    rows += [(20 + i, "\n".join(rnd.choice(lines, rnd.integers(1, 7)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect()}
    assert found == brute_lines(rows)
    assert found[2] == "" and found[3] == "p" and found[4] == a and found[6] == f"{short}\n{a}\nz"


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["_runs", "_run_id", "_may_change", "id", "mark", "finger", "hash"]
    docs = spark.createDataFrame([(1, "a\nb\nc", *names), (2, "a\nb\nc\nd", *names)], ["doc_id", "text", *names])
    cleaned = dedup_lines(docs)
    assert cleaned.columns == docs.columns
    assert sorted(map(tuple, cleaned.collect())) == [(1, "a\nb\nc", *names), (2, "d", *names)]


def test_texts_go_to_python_once_whatever_follows(spark):
    rows = [(i, f"one {i}\ntwo\nthree\nfour\nfive {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cleaned = dedup_lines(docs).where(F.trim("text") != "").withColumn("n", F.length("text"))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 3  # the filter in two branches, and the deletion
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {0: rows[0][1]} | {i: f"one {i}\nfive {i}" for i in range(1, 20)}


def test_units_are_made_a_few_documents_at_a_time(monkeypatch):
    monkeypatch.setattr("tallyline.llm.line_dedup.ROWS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8), pa.int64()), pa.array(["a\nb\nc"] * 7 + [None])], names=["id", "text"])
    made = list(_units([batch]))
    assert [len(m) for m in made] == [3, 3, 1] and [i for m in made for i in m.column("id").to_pylist()] == list(range(7))
