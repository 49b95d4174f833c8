"""Order MinHash fingerprints, whose likeness follows edit distance.

The k-mers of a text are its runs of ``POINTS`` code points, whatever its script or white space, each with the
number of its earlier occurrences, so that repeats count. ``fingerprint`` also has a form over words, which the
query does not use. All numbered k-mers are hashed once and dealt by hash over ``SLOTS`` slots. Each slot
selects the ``PICKED`` least hashes (one permutation for all slots; a slot with fewer k-mers hashes the whole set
of the text anew and selects from it), puts them back into the order in which they stand in the text, and hashes
that tuple. Two texts agree in a slot if they share its least k-mers in the same order: adding, losing or
moving text all lower the likeness. Documents are ordered, joined and compared by DataFrame operations; the two
fingerprints of a text come from numpy arrays in the task (``minhash_arrays``). ``fingerprint`` is the same as a column
of array functions. Long texts take time in proportion to length (and its logarithm) and never meet other rows.

A k-mer is 33 bits of hash with its place in the lower 31, one long: equal k-mers stand together after a plain sort,
and the place inside such a run is the occurrence. Of the numbered k-mers only those whose hash lies below a bound
that leaves some ``LEFT`` to a slot are kept. Where that leaves a slot short, the bound grows until all are kept: it
changes the time and never the result.

Likeness: with m of the slots that either text fills in agreement, j = m ** (1 / PICKED) estimates the share of k-mers
in common among all, and 2 j / (1 + j) the share of a text that the other has.

Defined results: null is the empty text; texts without words have the empty fingerprint, and are 1 alike; a
text of fewer than ``POINTS`` code points is one k-mer; in the form over words slots stay sparse, and those without a
k-mer are told by a mark of their own; equal texts have equal fingerprints. Repeated rows are one computation with a
row each. The next row of the last one is the first; of one row, it itself. Null ids come first, and equal ids follow
each other by text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import minhash_arrays
from .ordering import numbered
from .runtime import byte_slices, ship, stored, tidy

K = 2
#: Code points of a k-mer.
POINTS = 5
PICKED = 2
SLOTS = 48
#: Hex digits of a slot.
DIGITS = 4
#: Numbered k-mers that the bound leaves to a slot, about.
LEFT = 12
#: A packed k-mer has its place in the text below, its hash above.
_PLACE_BITS = 31
_PLACE = (1 << _PLACE_BITS) - 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, as the variable of a function over one element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _worded(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def _runs_of_points(text: Column) -> Column:
    """Every run of POINTS code points: none in a shorter text."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))." % POINTS), F.lit(1))


def kmers(text: Column) -> Column:
    """The k-mers of ``text`` over code points, as strings: at least one."""
    return F.when(F.length(text) >= POINTS, _runs_of_points(text)).otherwise(F.array(text))


def word_kmers(text: Column) -> Column:
    """Runs of K words; all words if fewer."""
    def runs(w: Column) -> Column:
        count = F.greatest(F.size(w) - (K - 1), F.lit(1))
        return F.transform(F.slice(w, F.lit(1), count), lambda _, i: F.array_join(F.slice(w, i + 1, K), " "))

    return _bound(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
                  lambda w: F.when(F.size(w) == 0, F.array(text)).otherwise(runs(w)))


def packed(grams: Column) -> Column:
    """A long for every k-mer: bits of its hash, then its place."""
    return F.transform(grams, lambda x, i: F.xxhash64(x).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("bigint")))


def _numbered(s: Column) -> Column:
    """(slot, hash, place) of the numbered k-mers, from sorted packed ones."""
    def hashed(x: Column, nth: Column) -> Column:
        return F.xxhash64(F.shiftright(x, _PLACE_BITS), nth)

    def starts(x: Column, i: Column) -> Column:
        return F.when(F.get(s, i - 1) >= x.bitwiseAND(F.lit(~_PLACE)), F.lit(None)).otherwise(i)

    def in_runs(ends: Column) -> Column:
        def run(first: Column, r: Column) -> Column:
            return F.transform(F.sequence(first, F.get(ends, r + 1) - 1), lambda i: F.struct(
                F.pmod(hashed(F.get(s, i), i - first), F.lit(SLOTS)).cast("int").alias("s"),
                hashed(F.get(s, i), i - first).alias("h"), F.get(s, i).bitwiseAND(F.lit(_PLACE)).cast("int").alias("p")))

        return F.flatten(F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), run))

    return _bound(F.concat(F.array_compact(F.transform(s, starts)), F.array(F.size(s))), in_runs)


def tuples(n: Column, missing=None) -> Column:
    """The fingerprint: for each slot the hash of its least k-mers in ``n``, which is in order, by place.

    ``missing`` makes the digits of a slot with fewer than PICKED of them; without, they are of the fewer.
    """
    starts = F.filter(F.transform(n, lambda x, i: F.when((i == 0) | (x["s"] != F.get(n, i - 1)["s"]), i)),
                      lambda i: i.isNotNull())

    def of(first: Column, r: Column, s: Column) -> Column:
        length = F.least(F.coalesce(F.get(s, r + 1), F.size(n)) - first, F.lit(PICKED))
        picked = F.transform(F.slice(n, first + 1, length), lambda x: F.struct(x["p"], x["h"]))
        return F.struct(F.get(n, first)["s"].alias("s"), F.when(F.lit(missing is None) | (length == PICKED), _digits(picked)).alias("d"))

    def written(m: Column) -> Column:
        other = missing or (lambda i: F.lit("-" * DIGITS))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.coalesce(m[i], other(i))), "")

    own = _bound(starts, lambda s: F.transform(s, lambda first, r: of(first, r, s)))
    return _bound(F.map_from_entries(own), written)


def _digits(picked: Column) -> Column:
    """The digits of a slot, from its (place, hash)."""
    return F.right(F.hex(F.xxhash64(F.transform(F.sort_array(picked), lambda x: x["h"]))), F.lit(DIGITS))


def _anew(n: Column):
    """For a slot, the tuple from all k-mers of the text, ``n``, hashed for this slot."""
    def digits(i: Column) -> Column:
        every = F.sort_array(F.transform(n, lambda x: F.struct(F.xxhash64(x["h"], i).alias("h"), x["p"].alias("p"))))
        return _digits(F.transform(F.slice(every, 1, PICKED), lambda x: F.struct(x["p"], x["h"])))

    return digits


def fingerprint(text: Column, points: bool = False) -> Column:
    """SLOTS hash tuples of DIGITS hex digits each, as one string: over words, or with ``points`` over code points."""
    known = F.coalesce(text, F.lit(""))
    grams = kmers(known) if points else word_kmers(known)
    every = _bound(F.sort_array(packed(grams)), lambda s: F.sort_array(_numbered(s)))
    return F.when(_worded(known), _bound(every, lambda n: tuples(n, _anew(n) if points else None))).otherwise(F.lit(""))


def with_fingerprints(df: DataFrame, text: str, edited: str) -> DataFrame:
    """``df`` with the fingerprints over code points of its columns ``text`` and ``edited`` in their places.

    The same as ``fingerprint`` with ``points``, by numpy arrays in the tasks: array functions are interpreted for each
    element, which costs a multiple at this volume.
    """
    ship(df.sparkSession)
    names, parameters = df.columns, (POINTS, SLOTS, PICKED, LEFT)
    at = names.index(text)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for part in byte_slices(batch, at):
                columns = [pa.array([minhash_arrays.fingerprint(t, *parameters) for t in c.cast(pa.binary()).to_pylist()], pa.string())
                           if name in (text, edited) else c for name, c in zip(names, part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(tidy(run), df.schema)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two fingerprints."""
    def slot(x: Column, i: Column) -> Column:
        return F.substr(x, i * DIGITS + 1, F.lit(DIGITS))

    empty = F.lit("-" * DIGITS)
    places = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    agreed = F.size(F.filter(places, lambda i: (slot(a, i) == slot(b, i)) & (slot(a, i) != empty)))
    filled = F.size(F.filter(places, lambda i: (slot(a, i) != empty) | (slot(b, i) != empty)))
    j = F.pow(agreed / F.greatest(filled, F.lit(1)), F.lit(1 / PICKED))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(2 * j / (1 + j))


def successors(keys: DataFrame) -> DataFrame:
    """Every row of ``keys`` (doc_id, key, tie, ...) with key and tie of the row after it by doc_id and tie.

    Rows are numbered in ranges of the order. Inside a range a window sees the successor; the last row of a
    range takes the first one of the next range, and the last of all the first of all: a row per range.
    """
    ordered = numbered(keys, "doc_id", "tie", label="successors")
    first = F.struct(F.col("key").alias("next_key"), F.col("tie").alias("next_tie"))
    ends = ordered.groupBy("chunk").agg(F.min(F.struct("nth", first.alias("first"))).alias("f"), F.max("nth").alias("last"))
    ahead = Window.orderBy("chunk")
    everywhere = ahead.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("chunk", "last", F.coalesce(F.lead("f.first").over(ahead), F.first("f.first").over(everywhere)).alias("over"))
    inside = F.lead(first).over(Window.partitionBy("chunk").orderBy("nth"))
    return (ordered.withColumn("_inside", inside).join(ends, "chunk")
            .withColumn("_next", F.when(F.col("nth") < F.col("last"), F.col("_inside")).otherwise(F.col("over")))
            .select(*keys.columns, "_next.next_key", "_next.next_tie"))


def documents_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text has the last quarter of the code points replaced by as many (or all) of the next document's first.
    """
    doc_id = F.col("doc_id").cast("bigint")
    # Neither key nor tie is null, so all joins below are on plain equalities.
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(0)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text", F.col("doc_id").isNull()))
    pairs = stored(successors(rows.select("doc_id", "key", "tie", F.length("text").cast("bigint").alias("n_chars"))), "pairs")
    # Rows equal in id and text follow each other, so however many they are, they and their successors are two cases at most.
    names = ["key", "tie", "next_key", "next_tie"]
    cases = pairs.groupBy(*names).agg(F.first("n_chars").alias("n_chars"))
    texts = rows.groupBy("key", "tie").agg(F.first("text").alias("text"))

    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    heads = (texts.withColumnsRenamed({"key": "next_key", "tie": "next_tie"}).join(cases, ["next_key", "next_tie"])
             .select(*names, "n_chars", F.substr("text", F.lit(1), quarter).alias("head")))
    both = (heads.join(texts, ["key", "tie"]).withColumn("stays", (F.col("n_chars") - quarter).cast("int"))
            .withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("stays")), "head"))
            .withColumn("edited_sha256", F.sha2("edited", 256)))
    made = with_fingerprints(both.select(*names, "edited_sha256", F.col("text").alias("fp"), F.col("edited").alias("edited_fp")), "fp", "edited_fp")
    made = stored(made, "fingerprints")
    following = made.groupBy(F.col("key").alias("next_key"), F.col("tie").alias("next_tie")).agg(F.first("fp").alias("next_fp"))
    made = made.join(following, ["next_key", "next_tie"])
    return pairs.join(made, names).select(
        "doc_id", "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
