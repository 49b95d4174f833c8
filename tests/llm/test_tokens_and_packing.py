import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from curbline.llm import packing, token_coder, token_store, tokens
from odd_rows import no_docs, odd_docs, small  # noqa: F401

PARTS = ["a", "B", "é", " ", " ", "\n", "\t", "'s", "1", "!", "$<", " ", "́", "<|endoftext|>", "\x1d", "Σ", "日", "word", "The", "ß", "²", "İ"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name, small):
    path = tokens.default_path(name)
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 14))) for _ in range(3000)]
    texts += [r.text for r in small[0].select("text").limit(60).collect()]
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert tokens.Encoder(path, room=9_000)(texts) == [tokens.packed(e.ids) for e in whole]


def check_packed(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [packing.END_ID]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start:start + capacity]
            want[r.doc_id, piece, start, len(own), zlib.crc32(tokens.packed(own))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_of_odd_rows_are_packed_without_gaps(odd_docs, no_docs):
    rows = packing.pack(odd_docs, capacity=64).collect()
    check_packed(rows, odd_docs, 64)
    assert packing.pack(no_docs).count() == 0


def test_packing_is_near_the_bound(small):
    rows = packing.pack(small[0], keep_ids=True).collect()
    used = check_packed(rows, small[0], packing.CAPACITY)
    assert used <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=8))
def test_fullest_bin_is_the_fullest(counts):
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= 50}
    chosen = packing.fullest(counts, 50)
    assert sum(chosen) == max(sums) and not Counter(chosen) - Counter(counts)
    placed = Counter()
    for times, lengths in packing.bin_patterns(counts, 50):
        assert sum(lengths) <= 50
        placed.update({n: times * k for n, k in Counter(lengths).items()})
    assert placed == Counter(counts)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65_535) | st.integers(0, 3), max_size=60), max_size=6))
def test_coder_round_trip(documents):
    section = token_coder.encode(list(range(len(documents))), [tokens.packed(d) for d in documents])
    ids, counts, back = token_coder.decode(section)
    assert ids.tolist() == list(range(len(documents))) and counts.tolist() == list(map(len, documents))
    assert back.tolist() == [i for d in documents for i in d]


def test_coder_learns_repeats_and_notices_damage():
    ids = tokens.packed(list(range(100, 140)) * 300)
    section = token_coder.encode([7], [ids])
    assert len(section) < len(ids) / 20
    for at in range(len(section)):
        for bit in (1, 64):
            broken = bytearray(section)
            broken[at] ^= bit
            with pytest.raises(ValueError):
                token_coder.decode(bytes(broken))
    for cut in (0, 10, 30, len(section) - 1):
        with pytest.raises(ValueError):
            token_coder.decode(section[:cut])
    with pytest.raises(ValueError):
        token_coder.decode(section + b"\0")
    with pytest.raises(ValueError):
        token_coder.encode([1], [tokens.packed([70_000])])


def test_coder_needs_fewer_bits_than_deflate():
    rng = np.random.default_rng(5)
    words = (rng.zipf(1.3, 400_000) % 5_000 * 13 + 7).astype("<u4")
    words[1::3] = words[::3][:len(words[1::3])] * 31 % 65_536  # a third follows from the id before
    section = token_coder.encode([1], [words.tobytes()])
    assert len(section) < len(zlib.compress(words.astype("<u2").tobytes(), 9))
    assert (token_coder.decode(section)[2] == words).all()


@pytest.mark.parametrize("n", [1, 255, 256, 257, 1_025, 70_001, (1 << 20) + 1, (1 << 20) + 4_097])
def test_coder_blocks_of_every_length(n):
    ids = (np.arange(n, dtype=np.uint64) * 2_654_435_761 % 65_536).astype("<u4")
    assert (token_coder.decode(token_coder.encode([1], [ids.tobytes()]))[2] == ids).all()


def test_coding_takes_little_more_than_the_tokenizer():
    ids = np.random.default_rng(5).zipf(1.3, 1 << 19) % 60_000
    raw, began = [ids.astype("<u4").tobytes()], time.process_time()
    token_coder.decode(token_coder.encode([1], raw))
    # 5 microseconds an id and more by adaptive tables, some 0.4 by models of the section.
    assert time.process_time() - began < 2e-6 * len(ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_and_their_runs_share_one_memory(name):
    path = tokens.default_path(name)
    whole, coded = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = [" the,the the. the", "the\nthe \n the", " ", "\n", " a", "the ", "a\tb c\t", "x\x1fy z", "a<|endoftext|> b", "1 12 1a-b", "Ünd ünd, ÜND", "\u00a0a b"]
    assert coded(texts) == [tokens.packed(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    assert not hasattr(coded, "runs") and ("the" if name.startswith("word") else " the") in coded.pieces


@pytest.mark.parametrize("section_ids", [1 << 22, 50])
def test_files_hold_all_documents_in_order(spark, odd_docs, tmp_path, section_ids):
    tokenizer = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    path = token_store.write(odd_docs, str(tmp_path / "files"), section_ids=section_ids)
    got = sorted(token_store.read(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
    start = 0
    for r, g in zip(rows, got, strict=True):
        ids = tokens.packed(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0])
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32, g.ids) == (r.doc_id, start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4


def test_no_documents_no_sections(no_docs):
    assert token_store.written_and_read(no_docs).count() == 0
