"""Context-mixing range coder for token ids, many independently reset blocks side by side.

A segment is a run of ids cut into blocks of ``BLOCK``. All blocks of a segment are coded in step, one
numpy lane each; no lane reads another's state, each starts from the same state and has its own
checksum, so a damaged block leaves the others readable.

Three predictions are mixed for every id. Order 2 and order 1 each predict the id that followed the
same two ids, or the same id, in the block so far, with a confidence that hits raise and misses
halve. Order 0 is the segment's id frequencies, kept in its header. The mixing weights of (order 2,
order 1, order 0) are adaptive counts in the context of both confidences and whether the two agree.
The coder is a carry-less range coder with 64-bit state that writes 16-bit words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1024
_MAGIC = b"TLCM"
_HEAD = struct.Struct("<4sHHQIII")
_SLOTS1, _SLOTS2 = 256, 512
_SHIFT = 20
_NONE = 0xFFFF
_GAIN, _LIMIT = 32, 4000
_U = np.uint64


class Damaged(ValueError):
    """A block's ids do not have the checksum that was written."""


def _shares(counts: np.ndarray) -> np.ndarray:
    """Frequencies with the sum 2**_SHIFT, at least 1 for every id that occurs."""
    held = counts > 0
    spare = (1 << _SHIFT) - int(held.sum())
    shares = held + (counts * (spare / max(counts.sum(), 1))).astype(np.int64)
    shares[np.argmax(shares)] += (1 << _SHIFT) - shares.sum()
    return shares


class _Mixer:
    """Model state of all lanes; encoder and decoder take the same steps.

    A slot holds a predicted id and, above its 16 bits, the confidence. A row of weights holds those of
    order 2, order 1 and order 0 in 16 bits each.
    """

    def __init__(self, lanes: int):
        self.slots1, self.slots2 = np.full(lanes * _SLOTS1, _NONE, np.uint32), np.full(lanes * _SLOTS2, _NONE, np.uint32)
        self.weights = np.full(lanes * 32, 4 | 4 << 16 | 24 << 32, np.int64)
        self.base1, self.base2 = np.arange(lanes) * _SLOTS1, np.arange(lanes) * _SLOTS2
        self.base_w = np.arange(lanes) * 32
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self, n: int) -> None:
        """Predicted ids, their weights and what they sum to, for the first n lanes."""
        last = self.last[:n]
        self.at1 = self.base1[:n] + ((last * 0x9E3B >> 4) & (_SLOTS1 - 1))
        self.at2 = self.base2[:n] + ((last * 0x9E3779B1 + self.before[:n] * 0x85EBCA77 >> 15) & (_SLOTS2 - 1))
        found1, found2 = self.slots1.take(self.at1), self.slots2.take(self.at2)
        self.k1, self.k2 = found1 >> 16, found2 >> 16
        self.p1, self.p2 = found1 & 0xFFFF, found2 & 0xFFFF
        self.row = self.base_w[:n] + _CONTEXT.take(self.k2 << 4 | self.k1 << 1 | (self.p1 == self.p2))
        self.w = self.weights.take(self.row)
        self.w0 = self.w & 0xFFFF
        self.w01 = self.w0 + (self.w >> 16 & 0xFFFF)
        self.total = self.w01 + (self.w >> 32)

    def learn(self, n: int, ids: np.ndarray, order: np.ndarray) -> None:
        """``order``: 0 where order 2 was right, 1 where order 1 was, else 2. ids as 32-bit integers."""
        now = self.w + _GAINS.take(order)
        full = np.flatnonzero(self.total > _LIMIT)  # few lanes at a time
        if len(full):
            now[full] = (now.take(full) >> 1 & 0x7FFF7FFF7FFF) + 0x100010001
        self.weights[self.row] = now
        for slots, at, k, p in ((self.slots1, self.at1, self.k1, self.p1), (self.slots2, self.at2, self.k2, self.p2)):
            hit = p == ids
            slots[at] = np.where(hit | (k > 1), p, ids) | _SURER.take(k << 1 | hit)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids


# Context of the weights, from both confidences (0 to 7) and whether the predictions agree.
_CONTEXT = np.array([min(k2, 3) << 3 | min(k1, 3) << 1 | same for k2 in range(8) for k1 in range(8) for same in (0, 1)])
_GAINS = np.array([_GAIN, _GAIN << 16, _GAIN << 32])
# The confidence after a miss and after a hit, in place.
_SURER = np.array([k << 16 for had in range(8) for k in (max(had >> 1, 1), min(had + 1, 7))], np.uint32)


class _Range:
    """Lower end and size of every lane's interval."""

    def __init__(self, lanes: int):
        self.low, self.size = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)

    def narrow(self, n: int, mixer: _Mixer, order: np.ndarray) -> None:
        """To the part of the order that is right."""
        unit = self.size[:n] // mixer.total.astype(_U)
        begin = np.where(order == 2, mixer.w01, np.where(order == 1, mixer.w0, 0))
        self.low[:n] += begin.astype(_U) * unit
        self.size[:n] = (mixer.w >> (order << 4) & 0xFFFF).astype(_U) * unit

    def narrow_plain(self, lanes: np.ndarray, starts: np.ndarray, shares: np.ndarray) -> None:
        """To the part of an id by its frequency."""
        unit = self.size.take(lanes) >> _U(_SHIFT)
        self.low[lanes] += starts * unit
        self.size[lanes] = shares * unit

    def settle(self, n: int):
        """Lanes of the first n that are to shift out the top 16 bits of their lower end, and that, until none is."""
        lanes, low, size = None, self.low[:n], self.size[:n]
        while True:
            same = (low ^ (low + size)) < _U(1 << 48)
            out = np.flatnonzero(same | (size < _U(1 << 40)))
            if not len(out):
                return
            low, size, same = low.take(out), size.take(out), same.take(out)
            lanes = out if lanes is None else lanes.take(out)
            if not same.all():
                size = np.where(same, size, (~low + _U(1)) & _U((1 << 40) - 1))
            yield lanes, low
            low, size = low << _U(16), size << _U(16)
            self.low[lanes], self.size[lanes] = low, size


def encode_segment(ids: np.ndarray, extra: bytes = b"") -> bytes:
    """All ids (below 65535) of a segment; ``extra`` is kept beside them."""
    if len(ids) and int(ids.max()) >= _NONE:
        raise ValueError("ids have to be below 65535")
    ids = np.asarray(ids, np.uint16)
    n, lanes = len(ids), -(-len(ids) // BLOCK)
    counts = np.bincount(ids, minlength=1)
    shares = _shares(counts) if n else np.zeros(1, np.int64)
    starts, shares_u = (np.cumsum(shares) - shares).astype(_U), shares.astype(_U)
    grid = np.zeros(lanes * BLOCK, np.uint32)
    grid[:n] = ids
    grid = grid.reshape(lanes, BLOCK).T.copy()
    coder, mixer = _Range(lanes), _Mixer(lanes)
    room = BLOCK * 2 + 8
    words = np.empty(lanes * room, np.uint16)
    firsts = np.arange(lanes) * room
    ends = firsts.copy()
    rest = n - (lanes - 1) * BLOCK if n else 0

    def write(where: np.ndarray, low: np.ndarray) -> None:
        at = ends.take(where)
        words[at] = low >> _U(48)
        ends[where] = at + 1

    with np.errstate(over="ignore"):
        for step in range(min(BLOCK, n)):
            m = lanes if step < rest else lanes - 1
            now = grid[step, :m]
            mixer.predict(m)
            second = now == mixer.p2
            order = np.where(second, 0, 2 - (now == mixer.p1))
            plain = np.flatnonzero(order == 2)
            coder.narrow(m, mixer, order)
            coder.narrow_plain(plain, starts.take(now.take(plain)), shares_u.take(now.take(plain)))
            mixer.learn(m, now, order)
            for where, low in coder.settle(m):
                write(where, low)
        every = np.arange(lanes)
        for _ in range(4):
            write(every, coder.low)
            coder.low <<= _U(16)
    checks = np.array([zlib.crc32(ids[i * BLOCK:(i + 1) * BLOCK].tobytes()) for i in range(lanes)], "<u4")
    table, extra = zlib.compress(shares.astype("<u4").tobytes(), 6), zlib.compress(extra, 6)
    used = ends - firsts
    body = b"".join(words[a:b].astype("<u2").tobytes() for a, b in zip(firsts, ends))
    head = _HEAD.pack(_MAGIC, 1, BLOCK, n, lanes, len(table), len(extra))
    return head + table + extra + used.astype("<u4").tobytes() + checks.tobytes() + body


def decode_segment(data: bytes) -> tuple[np.ndarray, bytes]:
    """(ids, extra) of an encoded segment; raises ``Damaged`` where a block fails its checksum."""
    magic, version, block, n, lanes, table_size, extra_size = _HEAD.unpack_from(data)
    if magic != _MAGIC or version != 1:
        raise Damaged("not a segment of token ids")
    at = _HEAD.size
    shares = np.frombuffer(zlib.decompress(data[at:at + table_size]), "<u4").astype(np.int64)
    at += table_size
    extra = zlib.decompress(data[at:at + extra_size])
    at += extra_size
    used, checks = np.frombuffer(data, "<u4", lanes, at).astype(np.int64), np.frombuffer(data, "<u4", lanes, at + 4 * lanes)
    body = np.frombuffer(data, "<u2", -1, at + 8 * lanes)
    if not n:
        return np.empty(0, np.uint16), extra
    id_at = np.repeat(np.arange(len(shares), dtype=np.uint32), shares)
    starts, shares = (np.cumsum(shares) - shares).astype(_U), shares.astype(_U)
    body = np.concatenate([body, np.zeros(8, "<u2")]).astype(_U)
    read, ends = np.cumsum(used) - used, np.cumsum(used)
    code = np.zeros(lanes, _U)
    for _ in range(4):
        code = code << _U(16) | body[read]
        read += 1
    coder, mixer = _Range(lanes), _Mixer(lanes)
    grid = np.zeros((block, lanes), np.uint16)
    rest = n - (lanes - 1) * block
    with np.errstate(over="ignore"):
        for step in range(min(block, n)):
            m = lanes if step < rest else lanes - 1
            mixer.predict(m)
            # Which part holds the code, without a second division: size // total was cut down.
            gone = code[:m] - coder.low[:m]
            unit = coder.size[:m] // mixer.total.astype(_U)
            order = (gone >= mixer.w0.astype(_U) * unit).astype(np.int64) + (gone >= mixer.w01.astype(_U) * unit)
            plain = np.flatnonzero(order == 2)
            coder.narrow(m, mixer, order)
            now = np.where(order == 0, mixer.p2, mixer.p1)
            value = (code.take(plain) - coder.low.take(plain)) // np.maximum(coder.size.take(plain) >> _U(_SHIFT), _U(1))
            found = id_at.take(np.minimum(value, _U((1 << _SHIFT) - 1)).astype(np.int64))
            now[plain] = found
            coder.narrow_plain(plain, starts.take(found), shares.take(found))
            mixer.learn(m, now, order)
            for where, _ in coder.settle(m):
                at = read.take(where)
                code[where] = code.take(where) << _U(16) | body.take(np.minimum(at, ends.take(where)))
                read[where] = at + 1
            grid[step, :m] = now
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n]
    for i in range(lanes):
        if zlib.crc32(ids[i * block:(i + 1) * block].tobytes()) != checks[i]:
            raise Damaged(f"block {i} of {lanes} fails its checksum")
    return ids, extra
