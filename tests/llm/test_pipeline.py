"""The pipeline's stages against plain versions of their decisions."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from weekcast.llm.common import save

SF = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]

    kept = save(stages["language_id"](spark, docs, SF), "test")
    assert kept.columns == docs.columns and kept.count() == docs.count()
    one = save(stages["simhash_near_dedup"](spark, kept, SF), "test")
    assert sorted(r[0] for r in rows(one)) == brute.linked(rows(kept))[1]
    cut = save(stages["suffix_array_dedup"](spark, one, SF), "test")
    want = {d: n - removed for d, n, removed, _, _ in brute.byte_repeats(rows(one)) if n > removed or not n}
    got = {r.doc_id: r for r in cut.collect()}
    assert got.keys() == want.keys()
    assert all(want[d] - 6 <= len(r.text.encode()) <= want[d] and r.n_chars == len(r.text) for d, r in got.items())
    clean = save(stages["benchmark_decontamination"](spark, cut, SF), "test")
    assert sorted(r[0] for r in rows(clean)) == sorted(d for d, _, hit, *_ in brute.contaminated(rows(cut), items) if not hit)
    assert cut.count() > clean.count()
    packed = save(stages["best_fit_packing"](spark, clean, SF), "test")
    assert packed.select("doc_id").distinct().count() == clean.count()
    whole = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, packed.select(columns).collect()))


def test_stages_take_awkward_rows(spark, hard, nothing, clashing):
    for name, stage in corpus_pipeline.STAGES:
        for table in (hard, clashing, nothing):
            made = stage(spark, table, SF)
            assert name == "best_fit_packing" or made.columns == table.columns
            assert (made.count() == 0) == (table is nothing)


def test_suffix_stage_keeps_other_columns_and_nulls(spark, hard):
    made = corpus_pipeline.suffix_dedup(spark, hard, SF)
    assert made.schema.simpleString() == hard.schema.simpleString()
    assert made.filter("text is null").count() == hard.filter("text is null").count()
    same = made.join(hard.select(F.col("doc_id"), "text", "lang", "source").distinct(), ["doc_id", "text"], "left_semi")
    assert same.count() > 30


def test_suffix_stage_runs_one_python_worker_a_task(spark, hard):
    plan = corpus_pipeline.suffix_dedup(spark, hard, "")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "ArrowEvalPython" not in plan


def test_stages_keep_every_column_s_values(spark, clashing):
    """Names like the stages' own, microseconds, maps with keys of any type, nested nulls."""
    whole = [c for c in clashing.columns if c not in ("text", "n_chars")]
    key = lambda r: tuple(str(sorted(r[c].items(), key=str) if isinstance(r[c], dict) else r[c]) for c in whole)
    before = {key(r) for r in clashing.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, clashing, SF)
        assert made.schema.simpleString() == clashing.schema.simpleString(), name
        rows = made.collect()
        assert rows and {key(r) for r in rows} <= before, name


def test_language_stage_drops_what_no_language_claims(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = ["Это русский текст о погоде, о городе и о людях.", "漢字 混ぜる 日本語の文章です", "2841 ### 9931 ----- $$$ x 4417 %% 11", "qxzj vvkq wjxq zzkp qqvx"]
    planted = spark.createDataFrame([(10**12 + k, t) for k, t in enumerate(junk)], "doc_id long, text string")
    made = corpus_pipeline.language_id(spark, docs.unionByName(planted, allowMissingColumns=True), SF)
    assert {r.doc_id for r in made.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
