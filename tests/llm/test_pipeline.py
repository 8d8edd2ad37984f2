"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline
import __spark_entry__
from pyspark.sql import functions as F
from tracelake.llm import queries, toxicity
from tests.llm.conftest import AWKWARD
from tests.llm.test_binpack import expected
from tests.llm.test_decontaminate import by_hand
from tests.llm.test_simhash import groups_by_hand

SF = "/root/testdata/sf0.001"


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_ids"]
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13
    assert set(queries.QUERIES) <= set(names) and set(__spark_entry__.oracle_sql()) <= set(names)


def test_every_stage_does_its_work(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~toxicity.held_out())
    scores = {i: s for i, s in zip(before, toxicity.score_texts([t.encode() for t in before.values()], model))}
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {i for i, s in scores.items() if s < toxicity.THRESHOLD}

    alone = stages["simhash_near_dedup"](spark, kept, SF)
    want = {int(c) for _, _, c in groups_by_hand([(i, before[i]) for i in sorted(ids)])}
    assert {r["doc_id"] for r in alone.collect()} == want

    clean = stages["benchmark_decontamination"](spark, alone, SF)
    clean_ids = {r["doc_id"] for r in clean.collect()}
    assert clean_ids == {i for i in want if not by_hand(before[i], bench)[1]}

    mixed = [r for r in stages["mixing"](spark, clean, SF).collect()]
    copies = {}
    for r in mixed:
        assert r["text"] == before[r["doc_id"]]
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= clean_ids and max(copies.values()) <= 2

    rows = spark.createDataFrame(mixed, docs.schema)
    got = [tuple(r) for r in stages["token_ids"](spark, rows, SF).orderBy("start").collect()]
    assert got == expected((r["doc_id"], r["text"]) for r in sorted(mixed, key=lambda r: r["doc_id"]))


def test_awkward_and_empty_tables_pass_every_stage(spark, awkward, empty):
    plain = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != "token_ids":
                assert docs.columns == plain.columns
        assert 0 <= docs.count() <= 2 * len(AWKWARD)


#: Every name that an operator of the first four stages gives a column of its own, now or in earlier versions.
HELPERS = ["row", "root", "label_fp", "_keep", "_keep_fp", "keep", "keep_fp", "_fp", "fp", "id", "key", "_key", "_copies", "copies", "_n", "_one", "_k",
           "_s", "_rate", "size", "source_size", "target", "hit", "_hit", "k1", "k2", "t", "w", "_toxicity", "toxicity", "toxic", "col", "node", "n"]


def test_clashing_columns_come_back_from_every_stage(spark, awkward):
    plain = awkward.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null").dropDuplicates(["doc_id"])
    clashing = plain
    for i, name in enumerate(HELPERS):
        clashing = clashing.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES:
        if name == "token_ids":
            assert sorted(map(tuple, stage(spark, clashing, SF).collect())) == sorted(map(tuple, stage(spark, plain, SF).collect()))
            continue
        got, want = stage(spark, clashing, SF), stage(spark, plain, SF)
        assert got.columns == clashing.columns
        rows = got.collect()
        assert rows and sorted((r["doc_id"], r["text"]) for r in rows if r["text"]) == sorted(
            (r["doc_id"], r["text"]) for r in want.collect() if r["text"])
        assert all(r[helper] == f"{i}:{r['doc_id']}" for r in rows for i, helper in enumerate(HELPERS))
