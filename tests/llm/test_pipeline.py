from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from helpers import documents
from __spark_entry__ import oracle_sql, queries
from stratalake.llm.mixing import mix_sources
from test_decontamination import brute as contaminated
from test_jaccard import brute as linked

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "sharding",
    ]
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    assert sorted(int(n.split("_")[0][2:]) for n in queries() if n[:2] == "op") == list(range(1, 14))


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no driver tables here")
def test_every_stage_against_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        kept[name] = (before.collect(), docs.collect(), docs.columns)
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(kept[n][2] == columns for n, _ in corpus_pipeline.STAGES[:-1])

    before, after, _ = kept["toxicity"]
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    # Documents without a label are neither right nor wrong.
    gone = [marks[i] for i in {r.doc_id for r in before} - {r.doc_id for r in after} if i in marks]
    assert gone and sum(gone) >= 0.9 * len(gone)

    before, after, _ = kept["ngram_jaccard_join"]
    groups = [eval(t) for t in linked([(r.doc_id, r.text) for r in before], 5, 80)]
    assert sorted(r.doc_id for r in after) == sorted({i for i, _, c in groups if i == c})

    before, after, _ = kept["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, _ in contaminated([(r.doc_id, r.text) for r in before], items)}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in dirty)

    before, after, _ = kept["source_mixing"]
    clean = spark.createDataFrame(before, corpus_pipeline.table(spark, SF, "documents").schema)
    copies = {r.doc_id: r.copies for r in mix_sources(clean).collect()}
    assert Counter(r.doc_id for r in after) == Counter({d: n for d, n in copies.items() if n})

    before, after, _ = kept["sharding"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    assert {r.shard for r in after} == set(range(8))
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(after)


def test_stages_bear_repeated_rows_and_rows_without_an_id(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "a")] * 5 + [(2, text, "a"), (None, "only here and " + text[::-1], "a"), (None, "only here and " + text[::-1], "b")]
    rows += [(None, text, "c"), (3, "", None), (4, None, None), (4, None, None), (5, "another text, of its own", "b")]
    docs = documents(spark, rows).drop("size", "shard", "pack", "token", "label", "score", "copies")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SF)
    assert kept.columns == docs.columns
    # Rows without words are linked with nothing, and all stay.
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted(
        [(1, text), (-1, "only here and " + text[::-1]), (3, ""), (4, ""), (4, ""), (5, "another text, of its own")]
    )
    assert corpus_pipeline.keep_one_of_each_group(spark, docs.limit(0), SF).count() == 0


def test_labels_that_are_mostly_toxic_drop_no_plain_text(spark, tmp_path):
    toxic = [(i, f"you utter moron {i * 7919:06d}", "a") for i in range(30)]
    plain = [(100 + i, f"some plain words about {i * 7919:06d}", "a") for i in range(20)]
    docs = documents(spark, [*toxic, *plain]).drop("size", "shard", "pack", "token", "label", "score", "copies")
    marks = [(i, 1, 1) for i, *_ in toxic] + [(i, 1, 0) for i, *_ in plain]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, *_ in plain}
