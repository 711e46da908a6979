from pathlib import Path

import numpy as np
import pytest
from helpers import AWKWARD, documents
from pyspark.sql import functions as F

from stratalake.llm import language
from stratalake.llm.common import in_training_part

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="no driver tables here")


def test_features_do_not_cross_documents():
    texts = ["Über Äpfel", "", "x", "über äpfel", "a 1 b"]
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
    rows = language.features(offsets, np.frombuffer(b"".join(raw), np.uint8))
    for i, r in enumerate(raw):
        alone = language.features(np.array([0, len(r)]), np.frombuffer(r, np.uint8))
        assert np.allclose(rows[i], alone[0])
    assert np.allclose(rows[0], rows[3]) and not rows[1].any()


@needs_data
def test_held_out_accuracy(spark):
    got = language.op4_language_machines(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 150
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@needs_data
def test_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_languages(docs, in_training_part(F.col("doc_id")), sample_rows=40)
    assert set(model.families.names) == {"germanic", "romance"}
    got = language.identify(documents(spark, [*AWKWARD, (70, "12 34 !?", "a")], extra=("guess", "letters")), model).collect()
    assert len(got) == len(AWKWARD) + 1
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 70)] == ["und"] * 4 and by_id[1].score == 0
    assert by_id[4].lang_pred in {"en", "de", "fr", "es"}
    assert language.identify(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    docs = documents(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string"))
    model = language.fit_languages(docs, in_training_part(F.col("doc_id")))
    assert model is None
    assert {(r.lang_pred, r.score) for r in language.identify(docs, model).collect()} == {("und", 0.0)}


def test_one_language_and_unknown_codes(spark):
    docs = documents(spark, [(i, f"some words {i} here", "a") for i in range(40)]).withColumn("lang", F.lit("zz"))
    model = language.fit_languages(docs, F.lit(True))
    assert {r.lang_pred for r in language.identify(docs, model).collect()} == {"zz"}
    assert language.family_of("zz") == "zz" and language.family_of("pt") == "romance"


def test_one_machine_for_each_pair_of_languages():
    rng = np.random.default_rng(3)
    names = [n for n in "abc" for _ in range(60)]
    # The second class lies between the others: no line parts it from both.
    middle = np.repeat([-1.0, 0.0, 1.0], 60)[:, None]
    rows = (np.c_[middle, np.zeros(180)] + rng.normal(0, 0.1, (180, 2))).astype(np.float32)
    model = language.fit_pairs(rows, names)
    assert model.weights.shape == (2, 3)
    p = model.probabilities(rows)
    assert np.allclose(p.sum(axis=1), 1) and [model.names[i] for i in p.argmax(axis=1)] == names
    # A machine knows the rows of its two names only.
    outer = [i for i, n in enumerate(names) if n != "b"]
    alone = language.fit_pairs(rows[outer], [names[i] for i in outer])
    assert np.allclose(model.weights[:, 1], alone.weights[:, 0], atol=1e-4)


def test_families_of_three_languages_have_three_machines(spark):
    words = {"es": "el perro y la casa con los ojos", "pt": "o cachorro e a casa com os olhos não", "it": "il cane e la casa con gli occhi che"}
    rows = [(3 * i + k, f"{words[lang]} {i}", lang) for i in range(40) for k, lang in enumerate(words)]
    docs = documents(spark, rows).withColumn("lang", F.col("source"))
    model = language.fit_languages(docs, F.lit(True))
    assert model.members["romance"].weights.shape[1] == 3
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert got == {i: lang for i, _, lang in rows}
