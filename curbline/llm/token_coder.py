"""Context-mixing coder for token ids, in independent, checksummed blocks.

A section is modelled before it is coded. Contexts of the last two ids (order 2, hashed) and of the last one (order 1) each
predict the id that follows them most often, with a class for how often it does; order 0 is how frequent each other id is.
The surer order's prediction is the candidate. For the flag "it is the candidate" both orders are mixed: its chance is that of
the pair of classes, and of whether the orders agree. An id that is not the candidate is coded by the order-0 frequencies.
All this drives a range variant of asymmetric numeral systems with 32 bits of state and 16-bit units.

The models stand in front of the blocks; every block starts from them alone. A block's checksum is that of its coded bytes,
the header's covers the models: damage is found before anything is decoded. Ids must be below 65,536.

Blocks are coded side by side, as lanes of numpy arrays. Only integers decide what is decoded, so that every machine gets the
same ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block at most, at least, and how many blocks a section has before they grow longer.
BLOCK, _SHORT, _LANES = 1024, 256, 4096
MAGIC = b"CTM3"
_HEAD = "<4sIIQI"
#: Stands for a null document id.
NULL_ID = -(1 << 63)
#: Contexts that came less often predict nothing.
_LEAST = 4
#: Classes of an order; 0 predicts nothing.
_CLASSES = 16
#: Rows of chances, and what marks a row whose candidate was right.
_ROWS = _HIT = 2 * _CLASSES ** 2
#: Positions of a section that are learnt from at once.
_SPAN = 16
_WHOLE = 1 << 16
_HASH, _SHIFT, _HALF = np.uint32(2654435761), np.uint32(7), np.uint32(16)
_LOW = np.uint32(_WHOLE - 1)
#: A share of everything, from the start: changes no state.
_NOTHING = np.uint32((_WHOLE - 1) << 16)


def _context2(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """16 bits of the last id and the one before it, both times ``_HASH``."""
    return (one + (two << _SHIFT)) >> _HALF


def _predictions(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of 65,536 contexts the id that follows most often, and the class of its share. Sorts ``pairs`` of both."""
    best, classes = np.zeros(_WHOLE, np.uint16), np.zeros(_WHOLE, np.uint8)
    pairs.sort()
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    times, pairs = np.diff(first, append=len(pairs)), pairs[first]
    own = pairs >> _HALF
    group = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    top = np.maximum.reduceat(times << 16 | (pairs & _LOW), group)
    total, hits = np.add.reduceat(times, group), top >> 16
    # A class for each half bit of the odds.
    level = np.clip(np.rint(2 * np.log2((hits + 0.5) / (total - hits + 0.5))) + 8, 0, _CLASSES - 1)
    kept = (total >= _LEAST) & (level > 0)
    at = own[group][kept]
    best[at], classes[at] = top[kept] & int(_LOW), level[kept]
    return best, classes


def _frequencies(counts: np.ndarray) -> np.ndarray:
    """Shares of 65,536 for the ids that occur, one at least for each."""
    total, present = int(counts.sum()), int((counts > 0).sum())
    shares = np.where(counts > 0, 1 + counts * (_WHOLE - present) // max(total, 1), 0)
    shares[counts.argmax()] += _WHOLE - shares.sum()
    return shares


class Models:
    """What a section's blocks share, from its parts as stored."""

    def __init__(self, id2, class2, id1, class1, chance, shares):
        self.parts = [a.astype(t) for a, t in zip((id2, class2, id1, class1, chance, shares), ("<u2", "u1", "<u2", "u1", "<u2", "<u4"))]
        # Candidate and, above it, class, of each context.
        self.two, self.one = (c.astype(np.uint32) << _HALF | i for i, c in ((id2, class2), (id1, class1)))
        self.chance = chance.astype(np.uint32)
        shares = shares.astype(np.int64)
        #: Of each id: its share less one, and below that where it begins.
        self.steps = ((shares.clip(1) - 1) << 16 | (np.cumsum(shares) - shares) & (_WHOLE - 1)).astype(np.uint32)

    def stored(self) -> bytes:
        return zlib.compress(b"".join(a.tobytes() for a in self.parts), 4)

    @classmethod
    def of(cls, stored: bytes) -> Models:
        raw, parts, at = zlib.decompress(stored), [], 0
        for n, kind in ((_WHOLE, "<u2"), (_WHOLE, "u1"), (_WHOLE, "<u2"), (_WHOLE, "u1"), (_ROWS, "<u2"), (_WHOLE, "<u4")):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        return cls(*parts)

    def candidate(self, one: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidate after ``one`` in the order-2 ``context``, and the row of its chance."""
        e2, e1 = self.two.take(context, mode="clip"), self.one.take(one, mode="clip")
        row = ((e2 >> _HALF) << np.uint32(4) | e1 >> _HALF) << np.uint32(1)
        return np.maximum(e2, e1) & _LOW, row | (((e2 ^ e1) & _LOW) == 0)


def _learn(grid: np.ndarray, lengths: np.ndarray) -> tuple[Models, np.ndarray]:
    """The models of ``grid`` (position, lane), and for each id the row of its chance, with ``_HIT`` if it is the candidate."""
    steps, lanes = grid.shape
    pad = np.zeros((steps + 2, lanes), np.uint16)
    pad[2:] = grid
    contexts = np.empty(grid.shape, np.uint16)
    pairs2, pairs1 = np.empty(grid.shape, np.uint32), np.empty(grid.shape, np.uint32)
    parts = [slice(t, min(t + _SPAN, steps)) for t in range(0, steps, _SPAN)]

    for part in parts:
        hashed = pad[part.start:part.stop + 1].astype(np.uint32) * _HASH
        contexts[part] = context = _context2(hashed[1:], hashed[:-1])
        np.bitwise_or(context << _HALF, grid[part], out=pairs2[part])
        np.bitwise_or(pad[part.start + 1:part.stop + 1].astype(np.uint32) << _HALF, grid[part], out=pairs1[part])
    # Only the last lane may be shorter.
    if lengths[-1] < steps:
        known = np.ones(grid.shape, bool)
        known[lengths[-1]:, -1] = False
        pairs2, pairs1 = pairs2[known], pairs1[known]
    (id2, class2), (id1, class1) = _predictions(pairs2.reshape(-1)), _predictions(pairs1.reshape(-1))
    models = Models(id2, class2, id1, class1, np.ones(_ROWS, np.uint16), np.zeros(_WHOLE, np.int64))
    rows = np.empty(grid.shape, np.uint16)
    seen, missed = np.zeros(2 * _HIT, np.int64), np.zeros(_WHOLE + 1, np.int64)
    for part in parts:
        ids = grid[part]
        candidate, row = models.candidate(pad[part.start + 1:part.stop + 1], contexts[part])
        hit = candidate == ids
        rows[part] = row | hit * np.uint32(_HIT)
        own, left = rows[part].ravel(), np.where(hit, np.uint32(_WHOLE), ids).ravel()
        if lengths[-1] < part.stop:
            own, left = own[known[part].ravel()], left[known[part].ravel()]
        seen += np.bincount(own, minlength=2 * _HIT)
        missed += np.bincount(left, minlength=_WHOLE + 1)
    hits, others = seen[_HIT:], seen[:_HIT]
    chance = np.clip((hits * 2 + 1) * _WHOLE // ((hits + others) * 2 + 2), 1, _WHOLE - 1)
    return Models(id2, class2, id1, class1, chance, _frequencies(missed[:-1])), rows


def _active(lengths: np.ndarray, t: int) -> int:
    """How many lanes have a ``t``-th id: only the last may be shorter."""
    return len(lengths) - (t >= lengths[-1])


def _encode(grid: np.ndarray, lengths: np.ndarray) -> tuple[Models, list[bytes]]:
    """The models and the coded blocks of ``grid`` (position, lane)."""
    models, rows = _learn(grid, lengths)
    steps, lanes = grid.shape
    state = np.full(lanes, _WHOLE, np.uint32)
    # A flag and an id take a unit each at most. Units are written from the end of a lane's row on, backwards.
    width = 2 * steps + 2
    units, at = np.zeros(lanes * width, np.uint16), np.arange(1, lanes + 1) * width

    def push(x: np.ndarray, share: np.ndarray, start: np.ndarray) -> np.ndarray:
        own = np.flatnonzero(x >> _HALF >= share)
        if len(own):
            place, value = at.take(own) - 1, x.take(own)
            units[place], at[own], x[own] = value, place, value >> _HALF
        # Below 2 ** 16, and exact: both are whole and below 2 ** 53.
        times = (x / share).astype(np.int32).view(np.uint32)
        return x + times * (np.uint32(_WHOLE) - share) + start

    # Coded backwards, so that it is decoded forwards.
    for t in range(steps - 1, -1, -1):
        n = _active(lengths, t)
        row = rows[t, :n]
        hit = row >= _HIT
        step = np.where(hit, _NOTHING, models.steps.take(grid[t, :n], mode="clip"))
        x = push(state[:n], (step >> _HALF) + np.uint32(1), step & _LOW)
        chance = models.chance.take(row & np.uint16(_HIT - 1), mode="clip")
        state[:n] = push(x, np.where(hit, chance, np.uint32(_WHOLE) - chance), chance * ~hit)
    rest = units.astype("<u2", copy=False)
    return models, [struct.pack("<I", x) + rest[a:b].tobytes()
                    for x, a, b in zip(state.tolist(), at.tolist(), range(width, (lanes + 1) * width, width))]


def _decode(models: Models, coded: bytes, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids (position, lane) of the blocks, ``sizes`` bytes each, that ``coded`` holds one after the other."""
    lanes, steps = len(sizes), int(lengths[0])
    units = np.append(np.frombuffer(coded, "<u2"), np.zeros(2, np.uint16))
    at = (np.cumsum(sizes) - sizes) // 2
    state = units[at] | units[at + 1].astype(np.uint32) << _HALF
    at += 2
    out = np.zeros((steps, lanes), np.uint16)
    owner = np.repeat(np.arange(_WHOLE, dtype=np.uint16), models.parts[-1].astype(np.int64))
    one, hashed = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
    for t in range(steps):
        n = _active(lengths, t)
        if n < len(one):
            one, hashed, state, at = one[:n], hashed[:n], state[:n], at[:n]
        before, hashed = hashed, one * _HASH
        candidate, row = models.candidate(one, _context2(hashed, before))
        chance = models.chance.take(row, mode="clip")
        slot = state & _LOW
        hit = slot < chance
        state = np.where(hit, chance, np.uint32(_WHOLE) - chance) * (state >> _HALF) + slot - chance * ~hit
        few = np.flatnonzero(state < _WHOLE)
        if len(few):
            place = at[few]
            state[few] = state[few] << _HALF | units[place]
            at[few] = place + 1
        slot = state & _LOW
        one = owner.take(slot, mode="clip")
        step = np.where(hit, _NOTHING, models.steps.take(one, mode="clip"))
        one = np.where(hit, candidate, one)
        state = ((step >> _HALF) + np.uint32(1)) * (state >> _HALF) + slot - (step & _LOW)
        few = state < _WHOLE
        state = np.where(few, state << _HALF | units.take(at, mode="clip"), state)
        at += few
        out[t, :n] = one
    return out


def encode(doc_ids: list[int], raw: list[bytes]) -> bytes:
    """A file section: directory of documents, models, then the ids (little-endian 32-bit in ``raw``, below 65,536) in blocks."""
    counts = np.array([len(r) // 4 for r in raw], np.int64)
    ids = np.frombuffer(b"".join(raw), "<u4")
    if len(ids) and ids.max() >= _WHOLE:
        raise ValueError("ids must fit 16 bits")
    # A step takes its time even with few lanes, so small sections have short blocks.
    block = min(BLOCK, max(_SHORT, -(-len(ids) // _LANES)))
    lanes = -(-len(ids) // block)
    lengths = np.minimum(block, len(ids) - block * np.arange(lanes))
    stored, blocks = b"", []
    if lanes:
        grid = np.zeros((lanes, int(lengths[0])), np.uint16)
        grid.ravel()[:len(ids)] = ids
        models, blocks = _encode(np.ascontiguousarray(grid.T), lengths)
        stored = models.stored()
    head = struct.pack(_HEAD, MAGIC, len(raw), lanes, len(ids), len(stored))
    directory = np.array(doc_ids, "<i8").tobytes() + counts.astype("<u4").tobytes()
    index = b"".join(struct.pack("<III", int(n), len(b), zlib.crc32(b)) for n, b in zip(lengths.tolist(), blocks))
    first = head + directory + index + stored
    return b"".join([first, struct.pack("<I", zlib.crc32(first)), *blocks])


def decode(section: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids. Any damage is a ValueError, found before anything is decoded.

    Sizes in the header are held against the length of the section before they are used, then the header against its
    checksum, then each block's coded bytes against theirs.
    """
    at = struct.calcsize(_HEAD)
    if len(section) < at + 4:
        raise ValueError("damaged section: too short")
    magic, docs, lanes, total, stored = struct.unpack_from(_HEAD, section)
    body = at + 12 * docs + 12 * lanes + stored
    if magic != MAGIC or len(section) < body + 4 or zlib.crc32(section[:body]) != struct.unpack_from("<I", section, body)[0]:
        raise ValueError("damaged header")
    doc_ids = np.frombuffer(section, "<i8", docs, at)
    counts = np.frombuffer(section, "<u4", docs, at + 8 * docs).astype(np.int64)
    index = np.frombuffer(section, "<u4", 3 * lanes, at + 12 * docs).reshape(lanes, 3).astype(np.int64)
    ends = body + 4 + np.cumsum(index[:, 1])
    if len(section) != (ends[-1] if lanes else body + 4) or counts.sum() != total or index[:, 0].sum() != total:
        raise ValueError("damaged section: lengths differ")
    if not lanes:
        return doc_ids, counts, np.empty(0, np.int64)
    for i, (end, (_, size, crc)) in enumerate(zip(ends.tolist(), index.tolist())):
        if zlib.crc32(section[end - size:end]) != crc:
            raise ValueError(f"block {i} is damaged")
    grid = _decode(Models.of(section[body - stored:body]), section[body + 4:], index[:, 1], index[:, 0])
    return doc_ids, counts, np.ascontiguousarray(grid.T).ravel()[:total]
