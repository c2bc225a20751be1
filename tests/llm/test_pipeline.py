"""The corpus pipeline on planted documents: what goes, what stays, and odd rows."""

import pytest

import corpus_pipeline as C


@pytest.fixture(scope="module")
def folder(spark, documents, text_of, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    good = lambda i: text_of(i, 120)
    junk = lambda i: " ".join(w.upper() + "!!" for w in text_of(i, 60).split())
    rows = [(i, junk(i) if i % 10 == 0 else good(i)) for i in range(300)]
    rows += [(400, good(3)), (401, good(3) + " tail"), (402, good(5) + " " + text_of(9001, 30)), (403, None), (404, ""), (None, good(950)), (405, good(7)), (405, good(7)), (406, text_of(960, 60_000))]
    documents(rows, class_id=1, bucket="clash").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, text_of(9001, 30)), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_each_stage_keeps_its_columns_and_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left, before = docs.columns, docs, {}
    for name, stage in C.STAGES[:-1]:
        before[name] = {(r.doc_id, r.text) for r in left.collect()}
        left = C.cut_lineage(stage(spark, left, folder))
        assert left.columns == columns
        before[f"after {name}"] = {(r.doc_id, r.text) for r in left.collect()}
        assert before[f"after {name}"] <= before[name]
    gone = lambda name: {i for i, _ in before[name] - before[f"after {name}"]}
    junk = {i for i in range(0, 300, 10)}
    assert len(gone("quality") & junk) >= 0.9 * len(junk) and len(gone("quality") - junk - {403, 404}) <= 3
    kept = {i for i, _ in before["after near_duplicates"]}
    assert {400, 401, 405} & kept == set() and {3, 7} <= kept
    assert gone("decontamination") <= {402, 5} and 402 not in {i for i, _ in before["after decontamination"]}
    shards = C.STAGES[-1][1](spark, left, folder)
    assert shards.count() == len(before["after source_mix"]) and {r.law for r in shards.collect()} == {"rows"}


def test_empty_documents(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, none, folder).count() == 0
