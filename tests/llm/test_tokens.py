import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm.bpe import BpeAutomaton, BpeCodec, bpe_decode, bpe_encode
from tallyline.llm.context_coder import BLOCK, Damaged, decode_segment, encode_segment
from tallyline.llm.packing import OpenWindows, pack
from tallyline.llm.token_counts import token_counts
from tallyline.llm.token_files import read_token_files, write_token_files
from tallyline.llm.words import WordIds, gathered

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


@pytest.fixture(scope="module")
def codec():
    return BpeCodec(BYTES)


@pytest.fixture(scope="module")
def words():
    return WordIds(WORDS)


TEXTS = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("thean's  \n\té²<|>"))), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoders_agree_with_the_library(codec, words, libraries, text):
    ids = libraries[BYTES].encode(text, add_special_tokens=False).ids
    assert codec.encode(text.encode()).tolist() == ids
    assert codec.decode(np.array(ids)) == libraries[BYTES].decode(ids, skip_special_tokens=False)
    assert words.ids(text.encode()).tolist() == libraries[WORDS].encode(text, add_special_tokens=False).ids


def merged(word: bytes, ranks: dict) -> list[bytes]:
    """Plain merging, lowest rank first and leftmost among equals."""
    parts = [bytes([b]) for b in word]
    while pairs := [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]:
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


@pytest.mark.parametrize("seed", range(20))
def test_automaton_accepts_what_random_merges_give(seed):
    rnd = random.Random(seed)
    labels, ranks, merges = {0: b"a", 1: b"b", 2: b"c"}, {}, []
    while len(merges) < 25:
        u, v = rnd.choice(list(labels)), rnd.choice(list(labels))
        if labels[u] + labels[v] not in labels.values():
            ranks[labels[u], labels[v]] = len(merges)
            merges.append((u, v, len(labels)))
            labels[len(labels)] = labels[u] + labels[v]
    automaton = BpeAutomaton(labels, merges)
    for _ in range(200):
        word = bytes(rnd.choices(b"abc", k=rnd.randrange(1, 30)))
        assert [labels[i] for i in automaton.encode(word)] == merged(word, ranks)


def expected(docs, library):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    return [(k, t, library.encode(t, add_special_tokens=False).ids) for k, t in rows]


def order(rows):
    return sorted(rows, key=str)


def test_bpe_round_trip(odd_docs, no_docs, libraries):
    rows = bpe_decode(bpe_encode(odd_docs, BYTES), BYTES).collect()
    want = [(k, len(ids), np.array(ids, "<u4").tobytes(), t) for k, t, ids in expected(odd_docs, libraries[BYTES])]
    assert order((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in rows) == order(want)
    assert bpe_decode(bpe_encode(no_docs, BYTES), BYTES).count() == 0


def test_token_counts(odd_docs, no_docs, libraries):
    rows = [tuple(r) for r in token_counts(odd_docs, WORDS).collect()]
    assert order(rows) == order((k, len(t.encode()), len(ids)) for k, t, ids in expected(odd_docs, libraries[WORDS]))
    assert token_counts(no_docs, WORDS).count() == 0


def test_packing_places_every_id_once(spark, libraries):
    rnd = random.Random(5)
    rows = [(i, "word " * rnd.choice([0, 3, 40, 300, 2047, 2048, 5000])) for i in range(300)] + [(300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    pieces = pack(docs, WORDS, open_windows=4).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(range(301))
    for key, text in rows:
        ids = [*libraries[WORDS].encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[key], key=lambda p: p["start"])
        assert b"".join(bytes(p["ids"]) for p in own) == np.array(ids, "<u4").tobytes()
        assert [p["start"] for p in own] == list(np.cumsum([0, *[p["length"] for p in own[:-1]]]))
        assert all(p["length"] * 4 == len(p["ids"]) and p["doc_tokens"] == len(ids) for p in own)
    used = []
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == list(np.cumsum([0, *[p["length"] for p in own[:-1]]]))
        used.append(own[-1]["offset"] + own[-1]["length"])
    assert max(used) <= 2048
    # Leftovers of 20 partitions are merged: no two of them would fit in one window but for the last few.
    assert sum(u <= 1024 for u in used) <= 4


def test_packing_odd_rows(odd_docs, no_docs, libraries):
    pieces = pack(odd_docs, WORDS).groupBy("doc_id").sum("length").collect()
    want = defaultdict(int)
    for k, _, ids in expected(odd_docs, libraries[WORDS]):
        want[k] += len(ids) + 1
    assert {r[0]: r[1] for r in pieces} == want
    assert pack(no_docs, WORDS).count() == 0


def test_open_windows_never_lose_items():
    rnd, windows, out = random.Random(1), OpenWindows(100, 3), []
    for i in range(1000):
        if closed := windows.place(size := rnd.randrange(1, 100), (i, size)):
            out.append(closed)
        assert len(windows.rooms) <= 3
    items = [x for _, items in [*out, *windows.rest()] for x in items]
    assert sorted(i for _, (i, _) in items) == list(range(1000))
    assert all(offset + size <= 100 for offset, (_, size) in items)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 65534), max_size=300), st.sampled_from([1, 2, 7, 65535]), st.binary(max_size=20))
def test_segments_round_trip(ids, below, extra):
    ids = np.array(ids, np.int64) % below
    found, kept = decode_segment(encode_segment(ids, extra))
    assert found.tolist() == ids.tolist() and kept == extra


def test_segments_of_many_blocks_and_damage():
    ids = np.random.default_rng(0).zipf(1.3, 5 * BLOCK + 17) % 5000
    data = encode_segment(ids)
    assert (decode_segment(data)[0] == ids).all() and len(data) < 2 * len(ids)
    broken = bytearray(data)
    broken[-2000] ^= 1
    with pytest.raises(Damaged):
        decode_segment(bytes(broken))
    with pytest.raises(ValueError):
        encode_segment(np.array([65535]))


def test_token_files_round_trip(spark, odd_docs, no_docs, libraries, tmp_path):
    write_token_files(odd_docs, str(tmp_path / "files"), WORDS)
    rows = read_token_files(spark, str(tmp_path / "files")).orderBy("start").collect()
    want = {(k, zlib.crc32(np.array([*ids, 1], "<u4").tobytes())) for k, _, ids in expected(odd_docs, libraries[WORDS])}
    assert {(r["doc_id"], zlib.crc32(bytes(r["ids"]))) for r in rows} == want and len(rows) == odd_docs.count()
    keys = [r["doc_id"] or -1 for r in rows]
    assert keys == sorted(keys)
    assert [r["start"] for r in rows] == list(np.cumsum([0, *[r["n_tokens"] for r in rows[:-1]]]))
    write_token_files(no_docs, str(tmp_path / "none"), WORDS)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_query_digests(spark, libraries):
    from tallyline.llm.queries import queries

    sf_dir = "/root/testdata/sf0.001"
    docs = expected(spark.read.parquet(f"{sf_dir}/documents.parquet"), libraries[BYTES])
    want = {(k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
            for k, t, ids in docs}
    assert {tuple(r) for r in queries()["op2_bpe_codec"](spark, sf_dir).collect()} == want
    counted = {r["doc_id"]: r["n_tokens"] for r in queries()["op6_token_counts"](spark, sf_dir).collect()}
    read = queries()["op9_token_files"](spark, sf_dir).collect()
    packed = queries()["op8_packing"](spark, sf_dir).groupBy("doc_id").sum("length").collect()
    plain = {k: n for k, n in counted.items()}
    assert {r["doc_id"]: r["n_tokens"] - 1 for r in read} == plain == {r[0]: r[1] - 1 for r in packed}


def test_pieces_are_remembered_once(libraries):
    """A word and the same piece of another word are one entry, and give what the library gives."""
    encoder = WordIds(WORDS)
    text = "Alpha (alpha) alpha's ALPHA, 42 beta-alpha <pad> [UNK] é É, çé's 's ' 4"
    want = libraries[WORDS].encode(text, add_special_tokens=False).ids
    assert encoder.ids(text.encode()).tolist() == want == encoder.ids(text.encode()).tolist()
    assert encoder.pieces is encoder and encoder[b"alpha"] == encoder[b"Alpha"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXTS, max_size=6))
def test_columns_agree_with_the_library(words, libraries, texts):
    column = pa.array([None, "skipped", *texts], pa.string()).slice(2)
    want = [libraries[WORDS].encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in words.each(column)] == want


def test_columns_in_small_chunks_keep_few_pieces(libraries, monkeypatch):
    for name, value in (("CHUNK_BYTES", 90), ("WORDS_AT_ONCE", 7), ("PIECES_AT_ONCE", 5), ("CACHED_PIECES", 20)):
        monkeypatch.setattr(f"tallyline.llm.words.{name}", value)
    encoder, rnd = WordIds(WORDS), random.Random(4)
    texts = [" ".join("".join(rnd.choices("abcDé,;.8", k=rnd.randrange(1, 9))) for _ in range(rnd.randrange(9))) for _ in range(300)]
    texts[7:9] = ["", "x<|endoftext|>y İ 日本 \xa0ſ"]
    want = [libraries[WORDS].encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.each(pa.array(texts))] == want
    assert not encoder and len(encoder.known) < 60 and len(encoder.older) < 60
    encoder.last[:] = False  # as in a vocabulary whose pieces have no marked end
    encoder.known, encoder.older = {}, {}
    assert [ids.tolist() for ids in encoder.each(pa.array(texts))] == want


def test_batches_are_put_together(monkeypatch):
    monkeypatch.setattr("tallyline.llm.words.CHUNK_BYTES", 60)
    given_ = [pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes], pa.string())], names=["t"]) for sizes in ([9], [], [30, 9], [99], [1])]
    assert [[len(t) for t in b.column(0).to_pylist()] for b in gathered(iter(given_))] == [[9, 30, 9], [99], [1]]
    assert list(gathered(iter([]))) == []


def test_codec_keeps_a_bounded_number_of_chunks(libraries, monkeypatch):
    monkeypatch.setattr("tallyline.llm.bpe.CACHED_CHUNKS", 20)
    monkeypatch.setattr("tallyline.llm.bpe.CACHED_ARCS", 30)
    codec, rnd = BpeCodec(BYTES), random.Random(3)
    for _ in range(60):
        text = " ".join("".join(rnd.choices("abcdé,;.", k=rnd.randrange(1, 9))) for _ in range(30)) + " the end's"
        assert codec.encode(text.encode()).tolist() == libraries[BYTES].encode(text, add_special_tokens=False).ids
        assert len(codec) <= 40 and len(codec.older) <= 40 and len(codec.automaton.arcs) <= 30
    assert " the" in codec  # used again and again
    whole = BpeCodec(BYTES)
    whole.encode(b" alpha,")
    assert whole[" alpha"] == whole._part(b" alpha") and set(whole) == {" alpha,", " alpha", ","}
