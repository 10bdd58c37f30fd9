"""Token ids of whole texts, with the ids of words or of their pieces remembered per worker.

For a tokenizer that drops white space, the ids of a text are those of its words one after another. A
column of texts is encoded in chunks: Arrow numbers a chunk's distinct words, their pieces are looked
up, the library's model tokenizes the pieces not met before together, and the ids are gathered by the
words' numbers. Other tokenizers of the ``tokenizers`` library encode whole texts. Special strings
inside texts are handled by the library.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import struct
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

# Words and their pieces are remembered up to this number, then forgotten all at once: a bound on a worker's memory.
CACHED_WORDS = 600_000
# Pieces after whose number those that were not used since the last time are forgotten.
CACHED_PIECES = 100_000
# Text of a chunk, unless a single text is longer; words and pieces that are looked up at once.
CHUNK_BYTES, WORDS_AT_ONCE, PIECES_AT_ONCE = 12 << 20, 64_000, 4_000

# Below U+0180, without one letter that lower-cases out of that range, lower-casing and the letter
# and number classes are the same in every Unicode version, and NFC changes nothing.
_ODD = r"[^!-~\xa0-ſ]|İ"
_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]"
    r"|[^\t-\r \x85\xa00-9²³¹¼½¾a-zªµºß-öø-ſ]+")
_PIECES_AND_ENDS = re.compile(_PIECES.pattern + r"|\n")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


_ID = attrgetter("id")


class WordIds(dict):
    """Word (bytes without white space) -> its ids as little-endian bytes; filled on demand.

    Pieces of words are kept beside the words, once for both: a piece that is a word has the same ids.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # The rules without the vocabulary, which would take tens of MB as Python objects.
        normal, split = [json.loads(x.__getstate__()) if x else {} for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Words that only the library may split: other characters, or a special string inside.
        self.odd = re.compile("|".join([_ODD, *map(re.escape, special)]))
        code = "H" if self.dtype.itemsize == 2 else "I"
        self.packed = [struct.Struct(f"<{n}{code}").pack for n in range(64)]
        # No special string is inside a word of ASCII letters.
        self.letters_are_plain = not any(re.fullmatch("[A-Za-z]*", t) for t in special)
        # A special string that lower-casing makes of a piece has other ids as a word.
        self.pieces: dict[bytes, bytes] = {} if any(_PIECES.fullmatch(t.lower()) for t in special) else self
        steps = split.get("pretokenizers", [])
        split = steps[0] if steps else {}
        # The word rules of _PIECES hold for this shape; any other tokenizer gets whole texts.
        self.by_word = (
            split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
            and [n["type"] for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and split["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"})
        self.alphabet = byte_alphabet()
        self.odd_words = "|".join([r"[^!-~\x{a0}-\x{17f}]|\x{130}", *map(re.escape, special)])
        # Tasks are parallel already. Its input is pieces in the vocabulary's characters, with blanks between.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.shown = "".join([" " if b == 32 else c for b, c in enumerate(self.alphabet)])
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a piece, and are nowhere else
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a lower-case piece, by the library's model."""
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= CACHED_WORDS:
                self.pieces.clear()
            written = piece.decode() if piece.isascii() else "".join([self.alphabet[b] for b in piece])
            ids = list(map(_ID, self.tokenize(written)))
            found = self.pieces[piece] = self.packed[len(ids)](*ids) if len(ids) < 64 else np.array(ids, self.dtype).tobytes()
        return found

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        if self.letters_are_plain and word.isalpha():
            ids = self._piece(word.lower())
        else:
            text = word.decode()
            if self.odd.search(text):
                ids = self._library(text)
            else:
                text = text.lower()
                ids = self._piece(text.encode()) if text.isalpha() else b"".join([self._piece(p.encode()) for p in _PIECES.findall(text)])
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text as little-endian bytes of ``dtype``."""
        if not self.by_word:
            return self._library(text.decode())
        return b"".join(map(self.__getitem__, text.split()))

    def ids(self, text: bytes) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of lower-case pieces, by the library's model."""
        width = self.dtype.itemsize
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            some = pieces[at:at + PIECES_AT_ONCE]
            written, _ = codecs.charmap_decode(" ".join(some).encode(), "strict", self.shown)
            made = np.array(self.bare.encode_batch_fast([written], add_special_tokens=False)[0].ids, self.dtype)
            ends, ids, start = (np.flatnonzero(self.last[made]) + 1) * width, made.tobytes(), 0
            if len(ends) != len(some) or ends[-1] != len(ids):  # a vocabulary without such ends
                self.known |= {piece: self._piece(piece.encode()) for piece in some}
                continue
            for piece, end in zip(some, ends.tolist()):
                self.known[piece] = ids[start:end]
                start = end

    def _words(self, words: pa.Array) -> tuple[bytes, np.ndarray]:
        """Ids of words, and how many each has."""
        odd = pc.match_substring_regex(words, self.odd_words)
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pc.if_else(odd, "", words)), "\n")
        pieces = _PIECES_AND_ENDS.findall(joined[0].as_py().lower() + "\n")
        new = set(pieces).difference(self.known)
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        self.known["\n"] = b""
        self._learn(list(new - again - {"\n"}))
        found = list(map(self.known.__getitem__, pieces))
        if len(self.known) > CACHED_PIECES:
            self.known, self.older = {}, self.known
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, pieces), bool, len(pieces)))
        for i, word in zip(at, words.take(pa.array(at, pa.int64())).to_pylist()):
            found[ends[i]] = self._library(word)
        sums = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))[ends] // self.dtype.itemsize
        return b"".join(found), np.diff(sums, prepend=0)

    def _chunk(self, texts: pa.Array) -> Iterator[np.ndarray]:
        words = pc.ascii_split_whitespace(texts)
        numbered = words.flatten().dictionary_encode()
        if not len(numbered):
            yield from (np.empty(0, self.dtype) for _ in range(len(texts)))
            return
        names, number = numbered.dictionary, numbered.indices.to_numpy()
        parts, counts = zip(*[self._words(names[i:i + WORDS_AT_ONCE]) for i in range(0, len(names), WORDS_AT_ONCE)])
        ids, counts = np.frombuffer(b"".join(parts), self.dtype), np.concatenate(counts)
        sizes = counts[number]
        after = np.concatenate([[0], np.cumsum(sizes)])
        lists = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))])
        bounds = after[lists].tolist()
        # Each word's ids lie side by side: one number counted up, set anew where a word begins.
        kind = np.int32 if after[-1] < 1 << 31 else np.int64
        places = np.repeat(((np.cumsum(counts) - counts)[number] - after[:-1]).astype(kind), sizes)
        places += np.arange(after[-1], dtype=kind)
        gathered = ids.take(places)
        del words, numbered, number, sizes, after, places
        for a, b in zip(bounds, bounds[1:]):
            yield gathered[a:b]

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column, null as empty."""
        if not self.by_word:
            yield from (np.frombuffer(self._library(t.decode()), self.dtype) for t in texts_of(texts))
            return
        sums, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < len(texts):
            held = int(sums[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sums, held + CHUNK_BYTES, "right")))
            yield from self._chunk(texts[at:end])
            at = end


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's encoder for a vocabulary file; it outlives a task."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def forget_encoders() -> None:
    """Called at the start of other operators' tasks: a reused worker holds the memory of one of them only."""
    _known.clear()
    pa.default_memory_pool().release_unused()


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text, null as empty."""
    for text in column.cast(pa.binary()):
        yield text.as_py() or b""


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to ``CHUNK_BYTES`` or more, as a chunk's distinct words are looked up once."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def end_id_added(ids: np.ndarray, end_id: int) -> np.ndarray:
    """The ids and then ``end_id``, as unsigned 32-bit integers."""
    return np.append(ids, end_id).astype("<u4")
