"""Order MinHash fingerprints of texts inside a task, by numpy arrays over the bytes of one text at a time.

``order_minhash`` defines the fingerprint; this makes the same one from UTF-8 bytes. A long text takes 16 bytes of memory
for each code point, and windows of bounded size for everything else.
"""

from __future__ import annotations

import numpy as np

#: K-mers that are hashed or numbered at once.
WINDOW = 1 << 20
_SEED = 42
_PLACE_BITS = 31
_PLACE = (1 << _PLACE_BITS) - 1
#: The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_PAD = bytes(32)


def _rotated(x, bits):
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _mixed(h):
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _with_eight(h, word):
    return _rotated(h ^ (_rotated(word * _P2, 31) * _P1), 27) * _P1 + _P4


def _with_four(h, word):
    return _rotated(h ^ (word * _P1), 23) * _P2 + _P3


def hash_longs(words, seed):
    """XXH64 of each long (uint64 in and out) with ``seed``, one or one for each."""
    return _mixed(_with_eight(seed + _P5 + np.uint64(8), words))


def hash_ints(words, seed):
    return _mixed(_with_four(seed + _P5 + np.uint64(4), words))


def hash_runs(padded, at, length):
    """XXH64 of the ``length`` bytes (fewer than 32) from each of ``at`` on. ``padded`` has 32 bytes more than the text."""
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    fours = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    h = np.full(len(at), np.uint64(_SEED) + _P5 + np.uint64(length), np.uint64)
    done = 0
    while length - done >= 8:
        h = _with_eight(h, eights[at + done])
        done += 8
    if length - done >= 4:
        h = _with_four(h, fours[at + done].astype(np.uint64))
        done += 4
    single = np.frombuffer(padded, np.uint8)
    for j in range(done, length):
        h = _rotated(h ^ (single[at + j].astype(np.uint64) * _P5), 11) * _P1
    return _mixed(h)


def packed_kmers(text: bytes, points: int):
    """Sorted longs, one for each run of ``points`` code points (the text, if shorter): bits of its hash, then its place."""
    padded = text + _PAD
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    count = len(starts) - points + 1
    if count < 1:
        # As many bytes as a lone shorter text can have, in valid UTF-8.
        starts, ends, count = np.zeros(1, np.int64), np.array([min(len(text), 31)]), 1
    else:
        ends = np.append(starts[points:], len(text))
    out = np.empty(count, np.int64)
    for a in range(0, count, WINDOW):
        at = starts[a:a + WINDOW][:count - a]
        lengths = np.minimum(ends[a:a + WINDOW] - at, 31)
        hashes = np.empty(len(at), np.uint64)
        for length in np.unique(lengths):
            chosen = slice(None) if (lengths == length).all() else lengths == length
            hashes[chosen] = hash_runs(padded, at[chosen], int(length))
        out[a:a + len(at)] = (hashes.view(np.int64) & ~_PLACE) | np.arange(a, a + len(at))
    out.sort()
    return out


def numbered(packed, limit: int):
    """(hash, place) of the numbered k-mers whose hash is ``limit`` at most."""
    hashes, places = [], []
    began = 0  # where the run that goes on from the window before started
    for a in range(0, len(packed), WINDOW):
        part = packed[a:a + WINDOW]
        kmer = part >> _PLACE_BITS
        before = np.empty_like(kmer)
        before[1:] = kmer[:-1]
        before[0] = packed[a - 1] >> _PLACE_BITS if a else ~kmer[0]
        index = np.arange(a, a + len(part))
        first = np.where(kmer != before, index, began)
        np.maximum.accumulate(first, out=first)
        began = int(first[-1])
        h = hash_ints((index - first).view(np.uint64), hash_longs(kmer.view(np.uint64), np.uint64(_SEED))).view(np.int64)
        low = h <= limit
        hashes.append(h[low])
        places.append(part[low] & _PLACE)
    return np.concatenate(hashes), np.concatenate(places)


def _by_slot(h, place, slots: int, picked: int):
    """Hashes and places of the least ``picked`` of each slot, and how many each has."""
    slot = h % slots
    order = np.lexsort((place, h, slot))
    counts = np.bincount(slot, minlength=slots)
    firsts = np.minimum((np.cumsum(counts) - counts)[:, None] + np.arange(picked), len(h) - 1)
    return h[order[firsts]], place[order[firsts]], counts


def fingerprint(text: bytes, points: int, slots: int, picked: int, left: int) -> str:
    """The fingerprint of a text: four hex digits for each slot; none if it has nothing but white space."""
    if not text.strip(b" \t\n\x0b\x0c\r"):
        return ""
    packed = packed_kmers(text, points)
    share = left * slots / len(packed)
    while True:
        limit = (1 << 63) - 1 if share >= 1 else int(share * 2.0 ** 64 - 2.0 ** 63)
        h, place = numbered(packed, limit)
        if share >= 1 or (len(h) and np.bincount(h % slots, minlength=slots).min() >= picked):
            break
        share *= 8
    hashes, places, counts = _by_slot(h, place, slots, picked)
    short = np.flatnonzero(counts < picked)
    if len(short):
        seeds = hash_longs(h.view(np.uint64), np.uint64(_SEED))
        for i in short:
            anew = hash_ints(np.full(len(h), i, np.uint64), seeds).view(np.int64)
            least = np.lexsort((place, anew))[:picked]
            hashes[i, :len(least)], places[i, :len(least)] = anew[least], place[least]
    rows = np.arange(slots)[:, None]
    in_order = hashes[rows, np.argsort(places, axis=1, kind="stable")]
    digits = np.full(slots, _SEED, np.uint64)
    for j in range(min(picked, len(h))):
        digits = hash_longs(in_order[:, j].view(np.uint64), digits)
    return "".join(f"{d:04X}" for d in (digits & np.uint64(0xFFFF)).tolist())
