"""SimHash near-duplicates, with pigeonring filtering before the full Hamming check.

A fingerprint of 64 bits is four segments of 16 bits on a ring. Of fingerprints at distance d <= 3, some
segment begins a chain on the ring in which the first l segments differ by no more than l * 3 / 4 bits, for
every l: 0, then 1, 2, 3 in all. The first two conditions make the join key: the segment itself, and one
half of the next segment, since one bit at most differs there. Pairs that meet on a key are checked for the
rest of the chain, and then in full.

A key that more than ``CROWDED`` fingerprints share is made longer: the 40 bits that it leaves out differ in 3 at most, so
of four parts of them one agrees, and each part makes a longer key. So the pairs that meet on a key don't grow with
the corpus, and no link is lost. Parts are of ``LONGER`` bits: keys have 24, 34, 41 and at last 46 bits.

Fingerprints, not documents, are joined: exact copies meet once. Within a key the fingerprints close to
the smallest one are linked to it first; keys whose fingerprints then share one hub are done, and in the others
only those outside the key's largest group are compared with the rest. So a group of near copies costs a
link each and not a link for each pair, and still no link between groups is lost.

Defined results: null and empty texts, and texts of white space, have fingerprint 0 and are linked like any
other; fewer than three words are one shingle; repeated rows are linked; null ids take part and count as
larger than any other when the smallest id is chosen. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .runtime import byte_slices, ship, stored, tidy, whole_row

BITS, SEGMENTS, WIDTH = 64, 4, 16
DISTANCE = 3
SEED = 42
SHINGLE = 3
#: Fingerprints of a key beyond which it is made longer, and by how many bits, time after time.
CROWDED = 1_000
LONGER = (10, 7, 5)


def fingerprint(text: str | None, seed: int = SEED, k: int = SHINGLE) -> int:
    """64 bits: bit i is set if over half of the shingle hashes have it."""
    import xxhash
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-k]]).tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())], dtype="<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, tie: Column | None = None) -> DataFrame:
    """doc_id, tie (a long, 0 unless given) and fp (the 64 bits as a signed long) of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for part in byte_slices(batch, 1):
                fps = np.array([fingerprint(t) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "tie", "fp"])

    tie = F.lit(0).cast("bigint") if tie is None else tie
    return docs.select(F.col("doc_id").cast("bigint"), "text", tie.alias("tie")).mapInArrow(tidy(run), "doc_id bigint, tie bigint, fp bigint")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND((1 << WIDTH) - 1)


def keyed(fps: DataFrame) -> DataFrame:
    """key, fp: for each of the four segments with either half of the next, where a chain may begin."""
    fp = F.col("fp")
    keys = []
    for i in range(SEGMENTS):
        following = _segment(fp, i + 1)
        for half, part in enumerate((following.bitwiseAND(0xFF), F.shiftrightunsigned(following, 8))):
            keys.append(F.shiftleft(F.lit(2 * i + half).cast("bigint"), 24) + F.shiftleft(_segment(fp, i), 8) + part)
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def near(a: Column, b: Column, distance: int = DISTANCE) -> Column:
    """A chain of segments within proportional budgets from some segment on, and the full distance."""
    differ = F.bit_count(a.bitwiseXOR(b))
    steps = [F.bit_count(_segment(a, i).bitwiseXOR(_segment(b, i))) for i in range(SEGMENTS)]
    chains = None
    for i in range(SEGMENTS):
        chain = steps[i] * SEGMENTS <= distance
        so_far = steps[i]
        for length in range(2, SEGMENTS + 1):
            so_far = so_far + steps[(i + length - 1) % SEGMENTS]
            chain = chain & (so_far * SEGMENTS <= length * distance)
        chains = chain if chains is None else chains | chain
    return chains & (differ <= distance)


def _left_out(key: Column, fp: Column) -> Column:
    """The 40 bits of ``fp`` that are not in a ``key`` of ``keyed``."""
    chain = F.shiftright(key, 24).cast("int")
    turn = F.shiftright(chain, 1) * WIDTH
    # A shift by 64 is one by 0.
    turned = F.call_function("shiftrightunsigned", fp, turn).bitwiseOR(F.call_function("shiftleft", fp, BITS - turn))
    upper = F.shiftleft(F.shiftrightunsigned(turned, 32), 8).bitwiseOR(F.shiftrightunsigned(turned, 16).bitwiseAND(0xFF))
    return F.when(chain.bitwiseAND(1) == 0, F.shiftrightunsigned(turned, 24)).otherwise(upper)


def _longer(crowded: DataFrame, bits: int) -> DataFrame:
    """key, fp, rest: for each key four longer ones, each with another part of ``rest``, which keeps what is left of it."""
    key, rest = F.col("key"), F.col("rest")
    longer = []
    for j in range(DISTANCE + 1):
        part = F.shiftrightunsigned(rest, j * bits).bitwiseAND((1 << bits) - 1)
        lower = rest.bitwiseAND((1 << j * bits) - 1)
        remaining = F.shiftleft(F.shiftrightunsigned(rest, (j + 1) * bits), j * bits).bitwiseOR(lower)
        longer.append(F.struct((F.shiftleft(F.shiftleft(key, 2) + j, bits) + part).alias("key"), remaining.alias("rest")))
    return crowded.select(F.explode(F.array(*longer)).alias("l"), "fp").select("l.key", "fp", "l.rest")


def meetings(fps: DataFrame) -> DataFrame:
    """key, fp, hub: the fingerprints that share a key with others, and the smallest of that key."""
    keys, met = keyed(fps).withColumn("rest", _left_out(F.col("key"), F.col("fp"))), None
    for level, bits in enumerate((*LONGER, None)):
        # Keys of unlike lengths are told apart by their length.
        shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("hub")).where("n > 1")
        here = stored(keys.join(shared, "key"), "keys")
        own = here if bits is None else here.where(F.col("n") <= CROWDED)
        settled = own.select(F.struct(F.lit(level).alias("level"), "key").alias("key"), "fp", "hub")
        met = settled if met is None else met.unionByName(settled)
        crowded = here.where(F.col("n") > CROWDED)
        if bits is None or crowded.isEmpty():
            return met
        keys = _longer(crowded, bits)


def links(fps: DataFrame) -> DataFrame:
    """a, b: links within the distance that connect what is connected. ``fps`` has distinct fp."""
    met = meetings(fps)
    stars = stored(met.where(F.col("fp") != F.col("hub")).where(near(F.col("fp"), F.col("hub")))
                   .select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct(), "stars")
    # Fingerprints with the same nearest hub are connected; more need not be known here.
    merged = stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    named = met.join(merged, met["fp"] == merged["node"], "left").select(
        "key", "fp", F.coalesce("component", "fp").alias("component"))
    sizes = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_keys = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("m")).where(
        "parts > 1").select("key", F.col("m.component").alias("main"))
    rest = stored(named.join(open_keys, "key"), "open-keys")
    few, every = rest.where("component <> main").alias("x"), rest.alias("y")
    across = few.join(every, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
                      & ((F.col("y.component") == F.col("y.main")) | (F.col("x.fp") < F.col("y.fp")))
                      & near(F.col("x.fp"), F.col("y.fp"))).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    return stars.unionByName(across)


def grouped(marked: DataFrame, least: Column) -> DataFrame:
    """fp, least (the smallest over its rows), component (the label of its class) of every distinct fingerprint."""
    distinct = stored(marked.groupBy("fp").agg(F.min(least).alias("least")), "distinct")
    reach = components(links(distinct.select("fp")))
    return distinct.join(reach, distinct["fp"] == reach["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable) of every row."""
    marked = stored(fingerprints(docs).drop("tie"), "fingerprints")
    joined = grouped(marked, F.col("doc_id"))
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(smallest, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of its smallest id (null last), then of the least text hash in the class.

    Classes are told apart by label, not by id: each keeps a row, also where ids are null or shared with other
    classes. Rows equal in id and text are folded before the shuffle.
    """
    doc_id, tie = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    # No key is null, so all joins are on plain equalities.
    marked = stored(fingerprints(docs, tie), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("own"), F.col("tie"))
    first = grouped(marked, least).groupBy("component").agg(F.min("least").alias("least")).select("least.*")
    others = [F.col("row")[c] for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    rows = docs.select(whole_row(docs).alias("row"), doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("own"), tie.alias("tie"))
    keys = ["none", "own", "tie"]
    folded = rows.groupBy(*keys).agg(F.min_by("row", rest).alias("row"))
    return folded.join(first, keys, "left_semi").select("row.*")
