"""BPE encoding and decoding by an automaton compiled from the merge list.

States know which pieces may follow the piece just read. The start has one state with an arc for
each byte. Every merge (u, v), in order, adds one gadget: the state that u leads to is split, its copy
loses the arc v, u leads to the copy, and wherever an arc u leaves, an arc uv now leaves too, to where
v led. All arcs of one piece lead to one state, so a state is stored as what it was copied from plus
the arc it lost, and an arc (state, piece) exists unless a state it was copied from lost the piece, or
what the piece begins with, before the piece was made. The automaton accepts exactly the sequences of
pieces that the merges produce, so a word has one path. Arcs are looked up once and then read from a
table. A pre-split word is encoded by following arcs, longest first; a position from which no path
goes on is never tried twice, so the time is linear in the word. Decoding emits the arcs' labels.

Null and empty texts give no ids and decode to the empty text. Rows are handled one by one, so null
and repeated keys stay. Of the input only the key and the text are read; clashing names do no harm.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm.words import byte_alphabet, texts_of

# White space as Unicode has it.
_SPACE = r"\t-\r \x85\xa0  -     　"
# Words with the blank before them, and white space: no piece of the split below crosses their ends.
_CHUNKS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# The vocabulary's split, for characters whose classes no Unicode version changes.
_SPLIT = regex.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_SPACE}\\p{{L}}\\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_PLAIN = re.compile(r"[^\x00-ɏ]")
# Text per record batch handed on.
BATCH_BYTES = 4 << 20
# Chunks and parts after whose number those that were not used since the last time are forgotten, and arcs looked up.
CACHED_CHUNKS, CACHED_ARCS = 250_000, 300_000


class BpeAutomaton:
    """Deterministic automaton over the pieces of a merge list; labels are bytes."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        """``labels``: id -> bytes of every piece. ``merges``: (left, right, merged id) in order."""
        self.labels = labels
        self.made = {}  # merged piece -> (its left part, its right part, rank)
        self.lost = {}  # (piece, piece after it) -> rank of the gadget that took the arc away
        self.state = {}  # piece -> state it leads to
        self.states = [(-1, -1, -1)]  # (copied from, arc lost, rank)
        made_of = {m for _, _, m in merges}
        self.ids = {}  # bytes -> piece, for pieces that some text gives
        for piece, label in labels.items():
            if len(label) == 1 and piece not in made_of:
                self.state[piece] = 0
                self.ids[label] = piece
        for rank, (u, v, uv) in enumerate(merges):
            if u not in self.state or v not in self.state or not self._leaves(u, v):
                continue  # no text brings u and v together
            if uv in self.state:
                raise ValueError(f"two merges make piece {uv}")
            before = self.state[v]
            self.states.append((self.state[u], v, rank))
            self.made[uv] = (u, v, rank)
            self.lost[u, v] = rank
            self.state[uv] = before
            self.state[u] = len(self.states) - 1
            self.ids[labels[uv]] = uv
        self.longest = max(map(len, self.ids), default=0)
        self.arcs: dict[int, bool] = {}

    def _spine(self, piece: int, side: int) -> Iterator[tuple[int, int]]:
        """The piece and its outermost parts on one side, each with the rank at which it was used up."""
        used = len(self.states) + len(self.lost) + 1 << 32
        while True:
            yield piece, used
            if piece not in self.made:
                return
            used = self.made[piece][2]
            piece = self.made[piece][side]

    def _leaves(self, u: int, w: int) -> bool:
        """Whether arc w leaves the state that u leads to."""
        firsts = list(self._spine(w, 0))
        for end, until in self._spine(u, 1):
            for first, by in firsts:
                rank = self.lost.get((end, first))
                if rank is not None and rank < until and rank <= by:
                    return False
        return True

    def encode(self, word: bytes) -> list[int]:
        """The one path that spells the word."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        n, ids, arcs = len(word), self.ids, self.arcs
        path, ends, at, limit, dead = [], [], 0, min(self.longest, len(word)), set()
        while at < n:
            last = path[-1] if path else -1
            for size in range(limit, 0, -1):
                piece = ids.get(word[at:at + size])
                if piece is None or at + size in dead:
                    continue
                if last >= 0:
                    arc = last << 32 | piece
                    ok = arcs.get(arc)
                    if ok is None:
                        if len(arcs) >= CACHED_ARCS:
                            arcs.clear()
                        ok = arcs[arc] = self._leaves(last, piece)
                    if not ok:
                        continue
                path.append(piece)
                ends.append(size)
                at += size
                limit = min(self.longest, n - at)
                break
            else:
                if not path:
                    raise ValueError("the vocabulary lacks a byte of the word")
                dead.add(at)
                path.pop()
                size = ends.pop()
                at -= size
                limit = size - 1
        return path


def _bytes_of(shown: str, byte_of: dict[str, int]) -> bytes:
    return bytes([byte_of[c] for c in shown])


def arc_labels(rules: dict) -> dict[int, bytes]:
    """Bytes of every id of a byte-level vocabulary, special strings included. Decoding needs no more."""
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    labels = {i: _bytes_of(t, byte_of) for t, i in rules["model"]["vocab"].items()}
    return labels | {t["id"]: t["content"].encode() for t in rules["added_tokens"]}


def spelled(labels: dict[int, bytes], ids: np.ndarray) -> str:
    return b"".join(map(labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


class BpeCodec(dict):
    """Whole texts to ids and back. As a dict: chunk or part of one -> its ids as 16- or 32-bit little-endian bytes.

    A part that is split again stays whole, so that chunks and their parts are kept together.
    """

    def __init__(self, path: str):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        rules = json.loads(self.library.to_str())
        split, model = rules["pre_tokenizer"] or {}, rules["model"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if model["type"] != "BPE" or rules["normalizer"] or model.get("end_of_word_suffix") or model.get(
                "continuing_subword_prefix") or any(split.get(k) != v for k, v in plain.items()):
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        self.byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        ids = model["vocab"]
        self.labels = arc_labels(rules)
        labels = {i: self.labels[i] for i in ids.values()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.automaton = BpeAutomaton(labels, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.special = {t["content"].encode(): t["id"] for t in rules["added_tokens"]}
        self.cut = re.compile(b"(" + b"|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + b")")
        self.dtype = np.dtype("<u2" if max(self.labels) < 1 << 16 else "<u4")
        self.older: dict[str, bytes] = {}

    def _bytes(self, shown: str) -> bytes:
        return _bytes_of(shown, self.byte_of)

    def _part(self, part: bytes) -> bytes:
        return np.array(self.automaton.encode(part), self.dtype).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHED_CHUNKS:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(chunk)
        if ids is None:
            if _PLAIN.search(chunk):
                ids = b"".join([self._part(self._bytes(p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)])
            else:
                parts = _SPLIT.findall(chunk)
                ids = b"".join([self[p] for p in parts]) if len(parts) > 1 else self._part(chunk.encode())
        self[chunk] = ids
        return ids

    def _plain(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, _CHUNKS.findall(text.decode())))

    def encode(self, text: bytes) -> np.ndarray:
        if self.special and any(s in text for s in self.special):
            ids = b"".join([np.array([self.special[part]], self.dtype).tobytes() if part in self.special
                            else self._plain(part) for part in self.cut.split(text) if part])
        else:
            ids = self._plain(text)
        return np.frombuffer(ids, self.dtype).astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        return spelled(self.labels, ids)


_known: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """The worker's codec for a vocabulary file; it outlives a task."""
    if path not in _known:
        _known[path] = BpeCodec(path)
    return _known[path]


def _encode(path: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, keys, rows, held = codec(path), [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                ids = tool.encode(text)
                keys.append(key)
                rows.append(ids.tobytes())
                held += len(text)
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        (keys, [len(r) // 4 for r in rows], rows), schema.types)], schema=schema)
                    keys, rows, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            (keys, [len(r) // 4 for r in rows], rows), schema.types)], schema=schema)
    return run


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit integers in one binary value."""
    schema = pa.schema([(id_col, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    pairs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(_encode(tokenizer, schema), f"{id_col} long, n_tokens long, ids binary")


@functools.cache
def _labels_of(path: str) -> dict[int, bytes]:
    """The worker's labels for a vocabulary file, those of its codec if it has one."""
    if path in _known:
        return _known[path].labels
    with open(path, encoding="utf-8") as file:
        return arc_labels(json.load(file))


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = _labels_of(path)
        for batch in batches:
            rows = [spelled(labels, np.frombuffer(x.as_py() or b"", "<u4")) for x in batch.column("ids")]
            yield batch.append_column("decoded", pa.array(rows, pa.string()))
    return run


def bpe_decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of ``bpe_encode`` with the text that the ids spell, as ``decoded``."""
    kept = encoded.drop("decoded")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(_decode(tokenizer), f"{names}, decoded string")
