"""Stages of the pipeline on rows without an id, with repeated ids, and on no rows."""

import random

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta river stone cloud maple ember frost harbor meadow lantern quartz willow copper".split()


def prose(seed, n=80):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice("abcdefgh") for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], SCHEMA)


def test_one_of_each_by_row(spark):
    near = prose(1) + " end"
    rows = [(1, prose(1)), (2, near), (None, prose(1)), (None, prose(2)), (None, prose(2)), (None, near + " more")]
    rows += [(5, prose(3)), (5, prose(4)), (5, prose(4)), (6, prose(3)), (7, None), (7, None), (8, None), (9, ""), (10, prose(5, 3))]
    df = table(spark, rows)
    got = pipeline.one_of_each(spark, df, "")
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    want = [(1, prose(1)), (None, prose(2)), (5, prose(3)), (5, prose(4)), (7, None), (8, None), (9, ""), (10, prose(5, 3))]
    assert kept == sorted(want, key=str)
    assert pipeline.one_of_each(spark, df.where("false"), "").count() == 0


def test_test_items_go_by_row(spark, tmp_path):
    item = prose(9, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    leak = f"{prose(1)} {item} {prose(2)}"
    df = table(spark, [(1, leak), (1, prose(3)), (None, leak), (None, prose(4)), (2, None), (3, "")])
    got = {(r.doc_id, r.text) for r in pipeline.no_test_items(spark, df, str(tmp_path)).collect()}
    assert got == {(1, prose(3)), (None, prose(4)), (2, None), (3, "")}
    assert pipeline.no_test_items(spark, df.where("false"), str(tmp_path)).count() == 0
