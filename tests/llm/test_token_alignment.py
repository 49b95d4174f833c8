import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from curbline.llm import token_alignment
from curbline.llm.tokens import byte_letters
from odd_rows import DOCS, no_docs, odd_docs, small  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
TEXTS = ["word", "a  b", " lead", "trail ", "\nline", "a\nb\n\n c", "tab\tand\r\nline \r x", "a\x1cb \x85 c", "<|endoftext|> <s> <0x41>", "x" + MARK + "y",
         "日本語　テキスト と", "naïve café́ é", "don't we'll I'M", "   ", "\n", " ", "a b   c", "😀 👩‍👩‍👧 x", "a\x00b", "1234567 3.14159,2", "{\r\n});\r\n  x"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), {c: b for b, c in byte_letters().items()}


def plain(tools, text):
    """Groups and links of a whole text by offsets, or None."""
    a, b, byte_of = tools
    if not text:
        return None
    coded = a.encode(" " + text, add_special_tokens=False)
    own_a = [bytes(byte_of[c] for c in t) for t in coded.tokens]
    ids_b = b.encode(text)
    own_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    raw = (" " + text).encode()
    if b"".join(own_a) != raw or b"".join(own_b) != raw:
        return None
    ends_a, ends_b = np.cumsum(list(map(len, own_a))), np.cumsum(list(map(len, own_b)))
    links = [(x, y) for x, ea, la in zip(coded.ids, ends_a, map(len, own_a)) for y, eb, lb in zip(ids_b, ends_b, map(len, own_b))
             if max(ea - la, eb - lb) < min(ea, eb)]
    groups, last = [], 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        groups.append(",".join(str(x) for x, e in zip(coded.ids, ends_a) if last < e <= end) + "|"
                      + ",".join(str(y) for y, e in zip(ids_b, ends_b) if last < e <= end))
        last = end
    return len(coded.ids), len(ids_b), groups, links


def plain_rows(tools, rows):
    found = {t: plain(tools, t) for t in {t for _, t in rows}}
    counts = Counter()
    for _, t in rows:
        counts.update(set(found[t][3]) if found[t] else ())
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = Counter()
    for d, t in rows:
        if not found[t]:
            out[(d, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        n_a, n_b, groups, links = found[t]
        out[(d, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest())] += 1
    return out


def test_units_and_windows_align_as_whole_texts_do(tools, monkeypatch):
    rng = np.random.default_rng(2)
    marks = ["a", "é", "The", " ", " ", "  ", "\n", "\n\n", "\t", "\r", "\r\n", " ", "　", "\x1c", "'s", "12", "--", ".", "日本", "<s>", "{", "}", ");", "\x00", "😀"]
    monkeypatch.setattr(token_alignment, "WINDOW", 5)
    align = token_alignment.Aligner(A, B)
    for text in TEXTS + ["".join(rng.choice(marks, rng.integers(1, 30))) for _ in range(1500)]:
        want, got = plain(tools, text), align(text)
        assert (want is None) == (got is None), text
        if want:
            assert got[0].tolist() == [want[0], want[1], len(want[2]), len(want[3])], text
            assert got[1] == hashlib.sha256(";".join(want[2]).encode()).hexdigest(), text
            codes = Counter(a * align.width + b for a, b in want[3])
            assert dict(zip(got[2].tolist(), got[3].tolist())) == codes, text


def got_rows(docs, **kw):
    return Counter(tuple(r) for r in token_alignment.align(docs, **kw).collect())


def test_rows_equal_brute_force(spark, tools, odd_docs, no_docs):
    texts = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(i, t, None, None, "r", "t", 1) for i, t in texts + texts[:9] * 20], DOCS).repartition(4)
    assert got_rows(docs) == plain_rows(tools, texts + texts[:9] * 20)
    short = odd_docs.where("doc_id is null or doc_id <> 6")
    assert got_rows(short) == plain_rows(tools, [(r.doc_id, r.text) for r in short.collect()])
    assert got_rows(no_docs) == Counter()


def test_slices_of_the_counts_add_up(small):
    docs = small[0].limit(60).cache()
    assert got_rows(docs, most=500) == got_rows(docs)


def test_long_texts_do_not_depend_on_windows(odd_docs, monkeypatch):
    long = odd_docs.where("doc_id = 6").first().text
    whole = token_alignment.Aligner(A, B)(long)
    monkeypatch.setattr(token_alignment, "WINDOW", 1_000)
    parts = token_alignment.Aligner(A, B)(long)
    assert whole[0].tolist() == parts[0].tolist() and whole[1] == parts[1]
    assert np.array_equal(whole[2], parts[2]) and np.array_equal(whole[3], parts[3])
