from pathlib import Path

import numpy as np
import pytest
from helpers import AWKWARD, documents
from pyspark.sql import functions as F

from stratalake.llm import toxicity

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="no driver tables here")

BASE = "you are an idiot and a loser said the clown to the moron while trash and worthless stupid words were pathetic "


def costs(spark):
    docs = documents(spark, [(i, BASE * 3, "a") for i in range(20)])
    return toxicity.trigram_costs(toxicity.count_trigrams(docs))


def test_disguised_words_are_restored(spark):
    model = costs(spark)
    for token, word in {
        "1d10t": "idiot", "l0ser": "loser", "m0r0n": "moron", "$tupid": "stupid", "tr4sh": "trash", "p@thetic": "pathetic",
        "looooser": "loser", "i d i o t": "idiot", "i.d.i.o.t": "idiot", "cl*wn": "clown", "worthle$$": "worthless",
    }.items():
        assert toxicity.decode(token, model) == word
    restorer = toxicity.Restorer(model)
    raw = ["He is an 1D10T, really!", "clean text, 3 words: a b", "", "so  l o s e r s!", "fine tion$$$ the###"]
    offsets = np.r_[0, np.cumsum([len(r.encode()) for r in raw])].astype(np.int64)
    out, data = restorer.batch(offsets, np.frombuffer("".join(raw).encode(), np.uint8))
    texts = [data[a:z].tobytes().decode() for a, z in zip(out[:-1], out[1:])]
    assert texts[0] == "He is an idiot, really!" and texts[1] == raw[1] and texts[2] == ""
    assert texts[3].startswith("so  loser") and texts[4] == raw[4]


def restored(model, texts):
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
    out, data = toxicity.Restorer(model).batch(offsets, np.frombuffer(b"".join(raw), np.uint8))
    return [data[a:z].tobytes().decode() for a, z in zip(out[:-1], out[1:])]


def test_each_form_of_disguise_reaches_the_decoder(spark):
    words = BASE + "devil and psycho and disgusting and naïve and дурак and "
    docs = documents(spark, [(i, words * 3, "a") for i in range(20)])
    model = toxicity.trigram_costs(toxicity.count_trigrams(docs))
    forms = {
        # Letters written twice.
        "stuupid": "stupid", "mooron": "moron", "so-stuupid,": "so-stupid,", "STUUPID": "stupid",
        # Signs as last letters.
        "idio+": "idiot", "devi1": "devil", "psych0": "psycho", "disgustin9": "disgusting", "psych0!": "psycho!", "devi|,": "devil,",
        # More signs than letters, signs of several bytes.
        "1d107": "idiot", "id10+!": "idiot!", "los€r": "loser", "£oser": "loser",
        # Stretched letters outside ASCII.
        "naïïïve": "naïve", "naÏïïve": "naïve", "дурааак": "дурак",
        # Pieces of two letters.
        "an id io t said": "an idiot said", "st up id": "stupid", "m 0 r 0 n": "moron", "l o s e r!": "loser!",
    }
    got = dict(zip(forms, restored(model, list(forms))))
    assert got == forms
    assert restored(model, ["really Letters"]) == ["really Letters"]


def test_plain_text_stays(spark):
    plain = [
        "worthless", "the loser and the clown!!!", "are we, or is it", "wow!!! 1234 100 %", "", "tt", "a b", "trash...", "end###", "x 1 2 3 4 5",
    ]
    docs = documents(spark, [(i, (BASE + "are we or is it so to be in an as we go ") * 3, "a") for i in range(20)])
    model = toxicity.trigram_costs(toxicity.count_trigrams(docs))
    assert restored(model, plain) == plain


def labelled(spark, n=300):
    rows = [(i, ("1d10t " if i % 5 == 0 else "friend ") + f"some words number w{i % 37} and w{i % 11} here", "a") for i in range(n)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, 1 if i % 5 == 0 else 0) for i in range(n) if i % 2 == 0], "doc_id long, quality int, toxic int")
    return docs, labels


def test_restored_text_is_scored(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels, F.col("doc_id") < 200)
    fresh = documents(spark, [(1, "what an idiot", "a"), (2, "what a friend", "a"), *AWKWARD])
    got = {}
    for r in toxicity.score_toxicity(fresh, model).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert got[1][0] > 0.3 > got[2][0]
    assert all(0 <= s <= 1 for scores in got.values() for s in scores)
    assert sum(map(len, got.values())) == len(AWKWARD) + 2
    assert toxicity.score_toxicity(documents(spark, []), model).collect() == []


def test_rare_words_are_not_shrunk_and_chance_is_not_learned():
    """A word of six toxic documents tells as much as one of sixty; words that fall to few toxic ones by chance tell nothing."""
    rng = np.random.default_rng(4)
    rows, y = [], []
    for i in range(2000):
        toxic = i % 10 == 0
        own = rng.choice(np.arange(5000, 60_000), 60, replace=False)
        row = set(own.tolist()) | ({1 if i % 300 else 2} if toxic else set())
        rows.append(sorted(row))
        y.append(float(toxic))
    at = np.array([f for row in rows for f in row], np.uint32)
    weights, bias = toxicity._logistic(at, np.r_[0, np.cumsum([len(r) for r in rows])], np.array(y))
    assert weights[1] + bias > 0 and weights[2] + bias > 0
    assert np.count_nonzero(weights[5000:60_000]) < 60


def test_labels_of_one_kind_and_conflicts(spark):
    docs, labels = labelled(spark, 40)
    only_clean = toxicity.fit_toxicity(docs, labels.where("toxic = 0"), F.lit(True))
    assert all(r.score < 0.3 for r in toxicity.score_toxicity(docs, only_clean).collect())
    messy = labels.selectExpr("doc_id", "toxic").unionByName(labels.selectExpr("doc_id", "1 - toxic AS toxic"))
    messy = messy.unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    nothing = toxicity.fit_toxicity(docs, messy, F.lit(True))
    assert not nothing.weights.any()


def test_four_thousand_toxic_and_ten_thousand_clean_documents_are_read(spark, monkeypatch):
    docs = spark.range(14_000).selectExpr("id AS doc_id", "concat('some words ', md5(string(id))) AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id < 4000 AS int) AS toxic")
    seen = []
    monkeypatch.setattr(toxicity, "_logistic", lambda at, offsets, y: (seen.append(y), (np.zeros(1 << toxicity.BITS), 0.0))[1])
    toxicity.fit_toxicity(docs, labels, F.lit(True))
    assert [(int(y.sum()), len(y)) for y in seen] == [(4000, 14_000)]


@needs_data
def test_held_out_rows(spark):
    got = toxicity.op10_noisy_channel_toxicity(spark, "/root/testdata/sf0.1")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    held = [r for r in got.join(truth, "doc_id").collect() if r.held_out]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits / sum(r.predicted for r in held) >= 0.9
    assert hits / sum(r.toxic for r in held) >= 0.9
    assert got.count() == 10_000
