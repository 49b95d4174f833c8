import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from curbline.llm import minhash_arrays, mixing, order_minhash, sharding, simhash, vptree
from curbline.llm.components import components
from odd_rows import no_docs, odd_docs, small  # noqa: F401


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    """doc_id -> smallest id reachable over fingerprints at three bits or fewer."""
    marks = {(r.doc_id, r.text): plain_fingerprint(r.text) for r in rows}
    distinct = sorted(set(marks.values()))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for (doc_id, _), f in marks.items():
        if doc_id is not None:
            least[root(f)] = min(least.get(root(f), doc_id), doc_id)
    return Counter((d, f"{f:016x}", least.get(root(f))) for (d, _), f in marks.items() for _ in [0])


def test_simhash_classes_equal_brute_force(odd_docs, small, no_docs):
    for docs in (odd_docs.dropDuplicates(["doc_id", "text"]), small[0]):
        rows = docs.collect()
        got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.classes(docs).collect())
        assert got == plain_classes(rows)
    assert simhash.classes(no_docs).count() == 0


def test_links_connect_a_crowd_of_near_fingerprints(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 62, 4)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(150):
            f = int(c)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                f ^= 1 << int(b)
            fps.add(f - (1 << 64) if f >= 1 << 63 else f)
    frame = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = simhash.links(frame)
    got = {r.node: r.component for r in components(links).collect()}
    unsigned = {f: f % (1 << 64) for f in fps}
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (unsigned[a] ^ unsigned[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {f: got.get(f, f) for f in fps} == {f: root(f) for f in fps}


def test_keep_first_keeps_one_of_each_class_and_all_columns(odd_docs):
    kept = simhash.keep_first(odd_docs)
    assert kept.schema == odd_docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and {3, 6, 7, 8} <= set(ids) and not {4, 5} & set(ids)


def test_keep_first_keeps_a_row_of_every_class_whatever_its_ids(spark):
    """Null ids, one id with unlike texts, and repeated rows with and without an id."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 10 ** 6, 40)) for _ in range(9)]
    rows = [(None, t, "x") for t in texts[:5]] * 2 + [(None, texts[5], "x"), (4, texts[5], "x"), (4, texts[5], "a"), (9, texts[5], "x")]
    rows += [(5, texts[6], "x"), (5, texts[7], "x"), (2, texts[6], "x"), (5, texts[8], "x"), (None, texts[8], "x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, `a.b` string").repartition(3)
    kept = simhash.keep_first(docs)
    want = [(None, t, "x") for t in texts[:5]] + [(4, texts[5], "a"), (2, texts[6], "x"), (5, texts[7], "x"), (5, texts[8], "x")]
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame(want, docs.schema).collect()))


def plain_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("which", ["odd", "small"])
def test_mix_meets_the_targets(odd_docs, small, which):
    docs = odd_docs if which == "odd" else small[0]
    rows, own = mixing.mix(docs).collect(), defaultdict(int)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, size(r.text)) for r in docs.collect())
    for r in rows:
        own[r.source] += r.size
    want, taken, largest = plain_targets(own), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == own[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and 0 <= r.rate <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    for s in own:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))


def test_mixed_repeats_rows_and_keeps_columns(odd_docs, no_docs):
    out = mixing.mixed(odd_docs)
    assert out.schema == odd_docs.schema
    want = Counter()
    for r in mixing.mix(odd_docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +want
    assert mixing.mixed(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_follow_prefix_sums(odd_docs, shards):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
                   for r in odd_docs.collect()))
    total, at, want, slots = sum(r[2] for r in rows), 0, [], Counter()
    for known, doc_id, size, crc in rows:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total))
        want.append((doc_id if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    got = [tuple(r) for r in sharding.shard(odd_docs, shards).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_no_rows_no_shards(no_docs):
    assert sharding.shard(no_docs).count() == 0


def test_next_texts_edits_and_equal_fingerprints(odd_docs, no_docs):
    docs = odd_docs.dropDuplicates(["doc_id", "text"])
    texts = [r.text or "" for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))]
    want = []
    for i, t in enumerate(texts):
        q = len(t) // 4
        want.append((len(t), hashlib.sha256((t[:len(t) - q] + texts[(i + 1) % len(texts)][:q]).encode()).hexdigest()))
    rows = order_minhash.documents_fingerprints(docs).collect()
    assert sorted((r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[1].near_next == 1.0
    assert by_id[3].fingerprint == by_id[4].fingerprint == by_id[5].fingerprint == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert 0.5 < by_id[6].near_edited < 0.95 and by_id[6].near_next < 0.1
    assert order_minhash.documents_fingerprints(no_docs).count() == 0
    repeated = order_minhash.documents_fingerprints(odd_docs)
    assert repeated.count() == odd_docs.count()


def test_fingerprint_follows_the_definition(spark):
    """Against a plain version that hashes the same numbered k-mers."""
    texts = ["a b c d e f g a b c a b", "x", "", "one two", "t " * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(order_minhash.fingerprint(F.col("t"))).collect()]
    assert got[2] == "" and all(len(g) == 4 * order_minhash.SLOTS for i, g in enumerate(got) if i != 2)
    for t, g in zip(texts, got):
        grams = max(1, len(t.split()) - 1) if t.split() else 0
        filled = sum(g[i:i + 4] != "----" for i in range(0, len(g), 4))
        assert filled <= grams and (filled > 0) == (grams > 0)
    moved = spark.createDataFrame([(" ".join(map(str, range(400))), " ".join(map(str, [*range(200, 400), *range(200)])))], "a string, b string")
    near = moved.select(order_minhash.likeness(order_minhash.fingerprint(F.col("a")), order_minhash.fingerprint(F.col("b")))).first()[0]
    assert 0.5 < near < 1.0  # the same words, in another order


@pytest.mark.parametrize("crowded", [2, 40, 10_000])
def test_crowded_keys_lose_no_link(spark, crowded, monkeypatch):
    """Fingerprints that share keys of every length, with near ones at 1 to 3 bits, in chains that lead on."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(15)
    fps = set()
    for shared in (24, 34, 46, 60):
        base = int(rng.integers(0, 1 << 62))
        turn = int(rng.integers(0, 64))
        for _ in range(30):
            own = base ^ (int(rng.integers(0, 1 << 62)) & ((1 << 64 - shared) - 1))
            own = (own << turn | own >> 64 - turn) & (1 << 64) - 1
            for flips in (0, 1, 2, 3):
                for bit in rng.choice(64, flips, replace=False):
                    own ^= 1 << int(bit)
                fps.add(own)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    met = simhash.meetings(spark.createDataFrame([(x,) for x in fps], "fp bigint"))
    together = defaultdict(set)
    for r in met.collect():
        together[tuple(r.key)].add(r.fp)
    pairs = {(a, b) for group in together.values() for a in group for b in group if a < b}
    near = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert near and near <= pairs
    labels = {x: x for x in fps}

    def root(x):
        while labels[x] != x:
            x = labels[x]
        return x

    for a, b in near:
        labels[root(a)] = root(b)
    whole = {frozenset(y for y in fps if root(y) == r) for r in {root(x) for x in fps}}
    found = {x: x for x in fps}
    labels = found
    for r in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp bigint")).collect():
        assert (min(r.a, r.b), max(r.a, r.b)) in near
        labels[root(r.a)] = root(r.b)
    assert {frozenset(y for y in fps if root(y) == r) for r in {root(x) for x in fps}} == whole


def plain_hash(*values):
    """The engine's xxhash64 over columns: each value with the hash so far as the seed. Ints have four bytes, in a tuple eight."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(8, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(4, "little")
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def plain_order_minhash(text):
    """Order MinHash over runs of code points, as the docstring tells it."""
    k, picked = order_minhash.POINTS, order_minhash.PICKED
    if not re.search(r"[^\x20\x09-\x0D]", text or ""):
        return ""
    grams = [plain_hash(text[i:i + k]) >> 31 for i in range(max(len(text) - k + 1, 1))]
    seen, numbered = Counter(), []
    for at, h in enumerate(grams):
        numbered.append((plain_hash((h,), seen[h]), at))
        seen[h] += 1
    slots = defaultdict(list)
    for h, at in numbered:
        slots[h % order_minhash.SLOTS].append((h, at))
    out = []
    for i in range(order_minhash.SLOTS):
        least = sorted(slots[i])[:picked]
        if len(least) < picked:  # the slot selects from the whole set, hashed for it
            least = sorted((plain_hash((h,), i), at) for h, at in numbered)[:picked]
        tuple_hash = plain_hash(*[(h,) for h, _ in sorted(least, key=lambda x: x[1])])
        out.append(f"{tuple_hash & (1 << 64) - 1:X}"[-order_minhash.DIGITS:])
    return "".join(out)


def test_order_minhash_equals_a_plain_version(spark):
    rng = np.random.default_rng(11)
    texts = ["a", "abcd", "abcde", "the cat sat on the mat, the cat sat", " \t ", "", None, "ab " * 90, "日本語のテキストはここにあります。" * 3]
    texts += ["".join(chr(c) for c in rng.integers(97, 103, n)) for n in (30, 200, 900)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(order_minhash.fingerprint(F.col("t"), points=True)).collect()]
    assert got == [plain_order_minhash(t) for t in texts]


def test_both_fingerprints_of_documents_equal_the_plain_version(spark, monkeypatch):
    """Texts that share their beginning with the edited one, with repeats in all three parts; also where bounds leave slots short."""
    rng = np.random.default_rng(12)
    texts = ["".join(chr(c) for c in rng.integers(97, 97 + letters, n)) for letters, n in ((2, 1500), (3, 700), (26, 3000), (26, 90), (4, 4000))]
    texts += ["", "abcd", "abcde", "abcdefg", " \t ", "a" * 1200, "ab" * 700, "\U0001f600é日" * 300, "word and " * 120, "  " * 400 + "x"]
    texts = [texts[i] for i in rng.permutation(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for left in (order_minhash.LEFT, 3):
        monkeypatch.setattr(order_minhash, "LEFT", left)
        rows = {r.doc_id: r for r in order_minhash.documents_fingerprints(docs).collect()}
        for i, t in enumerate(texts):
            q = len(t) // 4
            edited = t[:len(t) - q] + texts[(i + 1) % len(texts)][:q]
            assert rows[i].fingerprint == plain_order_minhash(t) and rows[i].edited_fingerprint == plain_order_minhash(edited), t[:20]


@pytest.mark.parametrize("window", [1, 7, 64])
def test_windows_of_a_long_text_change_nothing(window, monkeypatch):
    """Runs of equal k-mers and code points of all lengths across window ends, and a bound that must grow."""
    rng = np.random.default_rng(14)
    texts = ["a" * 300, "ab" * 200, "a\u00e9\u65e5\U0001f600" * 60, "x", "\U0001f600\u65e5", "one two three " * 20]
    texts += ["".join(chr(c) for c in rng.choice([97, 98, 0xE9, 0x65E5, 0x1F600], 800))]
    monkeypatch.setattr(minhash_arrays, "WINDOW", window)
    for t in texts:
        for left in (1, 12):
            got = minhash_arrays.fingerprint(t.encode(), order_minhash.POINTS, order_minhash.SLOTS, order_minhash.PICKED, left)
            assert got == plain_order_minhash(t), t[:20]


def test_a_third_of_the_rows_equal_is_two_cases(spark, monkeypatch):
    """Rows equal in id and text, also with a null id: each keeps its row, and only the last of them is followed by another text."""
    same = [(7, "one and the same text " * 9)] * 200 + [(None, "without an id " * 5)] * 50
    docs = spark.createDataFrame(same + [(i, f"text number {i} of some length, {i * i}") for i in range(8, 300)], "doc_id bigint, text string").repartition(6)
    computed = []
    made = order_minhash.with_fingerprints
    monkeypatch.setattr(order_minhash, "with_fingerprints", lambda df, *a: computed.append(df.count()) or made(df, *a))
    rows = order_minhash.documents_fingerprints(docs).collect()
    assert len(rows) == 542 and computed == [296]
    for doc_id, text in set(same):
        own = [r for r in rows if r.doc_id == doc_id]
        assert len(own) == same.count((doc_id, text)) and {r.fingerprint for r in own} == {plain_order_minhash(text)}
        assert sorted(r.near_next for r in own)[1:] == [1.0] * (len(own) - 1) and min(r.near_next for r in own) < 0.5


def test_texts_without_white_space_are_alike_after_an_edit(spark):
    """Long and short texts of any script, and a change in every second word."""
    rng = np.random.default_rng(6)
    texts = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9000, n)) for n in (900, 120, 40)]
    texts.append("".join(chr(c) for c in rng.integers(97, 123, 2000)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in order_minhash.documents_fingerprints(docs).collect()}
    assert all(len(r.fingerprint) == order_minhash.SLOTS * order_minhash.DIGITS and "-" not in r.fingerprint for r in rows.values())
    assert all(r.near_edited > 0.4 and r.near_next < 0.3 for r in rows.values())
    words = ["".join(chr(c) for c in rng.integers(97, 123, 12)) for _ in range(200)]
    changed = [w[:6] + "#" + w[7:] if i % 2 else w for i, w in enumerate(words)]
    pair = spark.createDataFrame([(" ".join(words), " ".join(changed))], "a string, b string")
    near = [order_minhash.likeness(*(order_minhash.fingerprint(F.col(c), points) for c in "ab")) for points in (False, True)]
    over_words, over_points = pair.select(*near).first()
    assert over_words == 0.0 and over_points > 0.4


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (vptree.FACTOR, 0.98), (0.7, 0.5)])
def test_search_against_brute_force(spark, factor, least, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 400)
    monkeypatch.setattr(vptree, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[500:560] = x[500]
    rows = [(i, [float(v) for v in r], "e") for i, r in enumerate(x)]
    rows += [(1000, None, "e"), (1020, [0.0] * 8, "e"), (1040, [float("nan")] * 8, "e"), (1060, [1.0, None] * 4, "e"), (1080, [], "e"), (None, [1.0] * 8, "e")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, v string")
    got = defaultdict(list)
    for r in vptree.search(frame, F.col("vec_id") % 20 == 0, k=20, factor=factor).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        score = (x.astype(float) * x[q].astype(float)).sum(1)
        best = [int(i) for i in np.lexsort((np.arange(900), -score)) if i != q][:20]
        hits += len(set(best) & {v for v, _ in found})
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True) and q not in [v for v, _ in found]
        if factor == 1.0:
            assert [v for v, _ in found] == best and [s for _, s in found] == pytest.approx(score[best].tolist(), abs=1e-12)
    assert hits / (20 * len(got)) >= least


def test_few_vectors_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (20, [0.5, 0.5, 1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in vptree.search(frame, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 1.0)]
    assert vptree.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_rows_and_ids_lose_no_neighbour(spark):
    """A query row twice, a candidate row six times, and an id with two unlike vectors."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(61, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(20, x[20].tolist())] + [(7, x[7].tolist())] * 5 + [(40, (-x[40]).tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in vptree.search(frame, F.col("vec_id") % 20 == 0, factor=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == {0, 20, 40, 60} and len(got[40]) == 40
    for q in (0, 20, 60):
        scores = sorted([(-float(x[i] @ x[q]), i) for i in range(61) if i != q] + [(float(x[40] @ x[q]), 40)])
        assert got[q] == [i for _, i in scores[:20]]


def test_mix_agrees_over_partitionings_and_splits_a_hot_row(spark):
    rows = [(1, "one two three four five", "a")] * 3_000 + [(i, " ".join(["w"] * (1 + i % 9)), "ab"[i % 2]) for i in range(2, 4_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    runs = [Counter(tuple(r) for r in mixing.mix(docs.repartition(n)).select("doc_id", "size", "target", "copies").collect()) for n in (3, 11)]
    assert runs[0] == runs[1]
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs.coalesce(2)).collect():
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 9 for s in target)


def test_equal_rows_are_cut_into_ranges_like_others(spark):
    """A third of the rows are equal: no range holds many more than its share."""
    from curbline.llm.ordering import numbered
    docs = spark.createDataFrame([(5,)] * 4_000 + [(i,) for i in range(8_000)], "doc_id bigint").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in numbered(docs, "doc_id").groupBy("chunk").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 12_000 and max(sizes) < 2 * 12_000 / 4


def test_mixed_keeps_the_row_that_is_least_by_its_other_columns(spark):
    docs = spark.createDataFrame([(1, "same text", "a", x) for x in ("z", None, "b", "y")] * 5 + [(2, "other", "b", "q")], "doc_id bigint, text string, source string, more string")
    rows = [{tuple(r) for r in mixing.mixed(docs.repartition(n)).where("doc_id = 1").collect()} for n in (2, 5)]
    assert rows[0] == rows[1] and len(rows[0]) == 1
