import numpy as np
import pytest

from curbline.llm import langid, pu_quality, toxicity
from odd_rows import labels, no_docs, no_labels, odd_docs  # noqa: F401


def held_quality(rows, label):
    pairs = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])


MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def medium(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet").cache(), spark.read.parquet(f"{MEDIUM}/labels.parquet")


def test_toxicity_ranks_held_out_rows(medium):
    docs, labels = medium
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert held_quality(rows, {r.doc_id: r.toxic for r in labels.collect()}) > 0.85


def test_quality_ranks_held_out_rows(medium):
    docs, labels = medium
    rows = pu_quality.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.predicted == (r.score >= 0.7) for r in rows)
    assert held_quality(rows, {r.doc_id: r.quality for r in labels.collect()}) > 0.95


def test_language_of_held_out_rows(medium):
    docs, _ = medium
    want = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in langid.identify(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in rows]) > 0.97


def test_odd_rows_and_tables(odd_docs, no_docs, labels, no_labels):
    for run in (toxicity.classify, pu_quality.classify):
        rows = run(odd_docs, labels).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 7}) == 1
        assert run(odd_docs, no_labels).count() == odd_docs.count() and run(no_docs, labels).count() == 0
    assert all(r.score < 1e-8 for r in toxicity.classify(odd_docs, no_labels).collect())
    for keep in (toxicity.keep_clean, pu_quality.keep_good):
        kept = keep(odd_docs, no_labels)
        assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
    rows = {r.doc_id: r for r in langid.identify(odd_docs).collect()}
    assert all((rows[i].lang_pred, rows[i].score) == ("und", 0) for i in (3, 4, 5)) and rows[6].lang_pred == "de"
    assert langid.identify(no_docs).count() == 0


def test_kept_rows_are_those_not_predicted(medium):
    docs, labels = medium
    bad = {r.doc_id for r in toxicity.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in toxicity.keep_clean(docs, labels).collect()} == {r.doc_id for r in docs.collect()} - bad


@pytest.fixture(scope="module")
def one_id(spark):
    """A few ids, of which one has 300 rows: 200 with one text and 100 unlike texts."""
    rows = [(1, "the same text again", "en")] * 200 + [(1, f"other text {i} of {i * i}", "en") for i in range(100)]
    rows += [(i, f"a line of its own {i}", "de") for i in range(2, 40)]
    labels = [(i, int(i % 2), int(i % 3 == 1)) for i in range(1, 40)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4).cache(),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_an_id_that_repeats_does_not_pass_the_bounds(one_id, monkeypatch):
    docs, labels = one_id
    rows = [r.text for r in toxicity.training_rows(docs, labels, "toxic", 60).collect()]
    assert len(rows) == 60 and rows.count("the same text again") <= 1
    every = [r.text for r in toxicity.training_rows(docs, labels, "toxic", 1000).collect()]
    assert sorted(every) == sorted(set(every)) and len(every) > 100
    assert sorted(rows) == sorted(r.text for r in toxicity.training_rows(docs.repartition(7), labels, "toxic", 60).collect())

    seen = []
    monkeypatch.setattr(pu_quality, "POSITIVE_ROWS", 15)
    monkeypatch.setattr(pu_quality, "UNLABELLED_ROWS", 25)
    monkeypatch.setattr(pu_quality, "class_prior", lambda p, u: seen.append((len(p), len(u))) or 0.5)
    monkeypatch.setattr(pu_quality, "train", lambda p, u, prior: seen.append((len(p), len(u))))
    pu_quality.ship(docs.sparkSession)
    pu_quality.fit(pu_quality.measured(docs), labels)
    assert seen == [(15, 25), (15, 25)]

    monkeypatch.setattr(langid, "train", lambda codes, labels, classes: len(codes))
    assert langid.fit(docs, 20)[1] == 20  # each of these texts is one window
    assert langid.fit(docs, 1000)[1] < 150


def test_gradients_through_time():
    """Against finite differences."""
    rng = np.random.default_rng(0)
    net = langid.Network(3, units=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes = rng.integers(0, 257, (5, 7)).astype(np.int16)
    y = rng.integers(0, 3, 5)
    _, grads = net.gradients(codes, y)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(grads[name].reshape(-1)) > 1e-4), 3):
            old, losses = flat[i], []
            for step in (5e-3, -5e-3):
                flat[i] = old + step
                losses.append(net.gradients(codes, y)[0])
            flat[i] = old
            assert (losses[0] - losses[1]) / 1e-2 == pytest.approx(grads[name].reshape(-1)[i], rel=0.05, abs=2e-4)


def test_prior_of_separable_classes():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(2, 1, (3000, 4)), rng.normal(-2, 1, (3000, 4))
    mixed = np.vstack([good[:1400], bad[:600]])[rng.permutation(2000)]
    prior = pu_quality.class_prior(good[1400:], mixed)
    assert prior == pytest.approx(0.7, abs=0.06)
    net = pu_quality.train(good[1400:], mixed, prior, steps=400)
    assert (net.forward(bad[600:])[0] < 0).mean() > 0.95 < (net.forward(good[:500])[0] > 0).mean()


def test_ngrams_are_counted_once_and_found_again():
    text = "Ünï  code\n" * 3
    known = toxicity.features(text)
    assert toxicity.features(text.upper()).tolist() == known.tolist() and len(known) == len(set(known))
    assert toxicity.Lookup(known)(text).tolist() == list(range(len(known)))
    assert len(toxicity.Lookup(np.empty(0, np.uint32))(text)) == 0


def test_long_texts_are_hashed_in_windows(monkeypatch):
    text = " ".join(f"word{i % 91} Ünï{i}" for i in range(900))
    whole = toxicity.features(text)
    for window in (5, 64, 1_000):
        monkeypatch.setattr(toxicity, "WINDOW", window)
        assert np.array_equal(toxicity.features(text), whole)
    assert len(toxicity.features("")) == 0 and len(toxicity.features("ab")) == 1


def test_batches_are_cut_by_bytes():
    import pyarrow as pa
    from curbline.llm.runtime import byte_slices
    texts = ["a" * 100, None, "", "b" * 5_000, "c" * 10, "d" * 10] + ["e"] * 5_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "text"])
    parts = list(byte_slices(batch, 1, 1_000))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts and all(p.num_rows for p in parts)
    assert all(sum(len(t or "") for t in p.column(1).to_pylist()) <= 1_000 or p.num_rows == 1 for p in parts)


def test_a_bound_on_hashes_draws_the_same_ids(spark):
    from curbline.llm.runtime import drawn
    from pyspark.sql import functions as F
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    least = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(50).collect()]
    assert [r.doc_id for r in drawn(ids, "doc_id", 50).collect()] == least
    hot = ids.select((F.col("doc_id") % 3).alias("doc_id"))
    assert drawn(hot, "doc_id", 50).count() == 50
