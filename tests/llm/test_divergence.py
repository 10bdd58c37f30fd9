import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tallyline.llm import divergence as module
from tallyline.llm.divergence import counted, divergence, pieces, shares

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, held, groups, kept = defaultdict(Counter), Counter(), defaultdict(set), defaultdict(list)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = Counter(_TERM.findall((text or "").translate(upper)))
        counts[lang, source] += found
        groups[lang].add(source)
        held.update((lang, t) for t in found)
    for (lang, term), n in held.items():
        if n >= module.LEAST_DOCUMENTS:
            kept[lang].append(term)
    out = set()
    for lang, sources in groups.items():
        v = len(kept[lang])

        def p_of(c):
            n = sum(c[t] for t in kept[lang])
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept[lang]}

        q = p_of(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: p_of(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept[lang]), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept[lang] if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                out |= {(lang, s, part, i.decode(), -f, n) for n, (f, i) in enumerate(sorted(found)[:most], 1)}
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], "lang string, source string, text string, term string, n int")
    found = [tuple(r) for r in divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found))
    return set(found)


def made(n=900, sources=6):
    rnd, rows = np.random.default_rng(5), []
    words = [f"{a}{b}" for a in ("Ünder", "straße", "ABC", "zz", "日本", "É") for b in "abcdefghijklmnopqrst"]
    for i in range(n):
        source = None if i % 11 == 0 else f"s{0 if i % 3 == 0 else rnd.integers(sources)}"
        weights = rnd.integers(1, 4) * (np.arange(len(words)) % (2 + i % 3) + 1.0)
        text = " ".join(rnd.choice(words, rnd.integers(0, 40), p=weights / weights.sum()))
        rows.append(((None, "en", "de")[i % 3], source, None if i % 50 == 7 else text + "_x9y\x00tail" * (i % 2)))
    return rows + [("rare", "a", "one two"), ("rare", "b", ""), ("rare", "c", None), ("single", "a", "x")]


def test_divergence_equals_brute_force(spark):
    rows = made()
    assert run(spark, rows) == brute(rows)


def test_shards_blocks_and_pieces_change_nothing(spark, monkeypatch):
    rows = made(500)
    for name, value in (("CELLS", 40), ("BLOCK", 2), ("PIECE", 200), ("HELD", 50), ("RANKS", 50)):
        monkeypatch.setattr(module, name, value)
    monkeypatch.setattr(module, "LEAST_DOCUMENTS", 10)
    assert run(spark, rows) == brute(rows)


def test_counts_of_a_batch():
    batch = pa.RecordBatch.from_pydict({"lang": ["e", "e", None, "e"], "source": ["a", "a", "a", None],
                                        "text": ["B b c", "b", None, "1 2"]})
    found = {tuple(r.values()) for r in counted(batch).to_pylist()}
    assert found == {("e", "a", "b", 3, 2), ("e", "a", "c", 1, 1), ("e", "a", "", 0, 0), ("", "a", "", 0, 0), ("e", "", "", 0, 0)}
    assert [len(p) for p in pieces(batch)] == [4]
    assert list(pieces(batch.slice(0, 0))) == []


def test_pieces_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(module, "PIECE", 4)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["é", "ab", "c", None, "long text", "", "d"])})
    assert [p.column(0).to_pylist() for p in pieces(batch)] == [["é", "ab"], ["c", None], ["long text"], ["", "d"]]


def test_shares_are_exact():
    rnd = np.random.default_rng(2)
    total = rnd.integers(10, 9 * 10**15, 500)
    counts = (rnd.random(500) * (total - 5)).astype(np.int64)
    assert shares(counts, total).tolist() == [1 + 10**9 * (c + 5) // t for c, t in zip(counts.tolist(), total.tolist())]


def test_divergence_odd_rows(spark, odd_docs):
    assert run(spark, []) == set()
    long = [("en", "a", "ab " * 100_000), ("en", "b", "x" * 200_000)] * 30
    assert run(spark, long) == brute(long)
    assert divergence(odd_docs.withColumn("lang", odd_docs["id"]).withColumn("source", odd_docs["mark"])).count() == 0
