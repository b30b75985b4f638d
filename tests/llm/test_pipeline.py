import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import decontam, langid, mixing, neardup, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The rows after each stage, written and reread."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def test_stages_and_columns(spark, kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mix", "token_ids"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(kept[n].columns == columns for n in list(kept)[:-1])
    assert kept["token_ids"].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_each_decision_takes_effect(spark, kept):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {n: [r.doc_id for r in df.select("doc_id").collect()] for n, df in kept.items()}
    scored = langid.predicted(docs.select("doc_id", "text"), langid.fit(docs.select("doc_id", "text", "lang")))
    assert sorted(ids["language"]) == sorted(r.doc_id for r in scored.filter("lang_pred <> 'und' and score >= 0.4").collect())
    groups = neardup.near_duplicates(kept["language"], 5, 80)
    assert sorted(ids["near_duplicates"]) == sorted(r.doc_id for r in groups.filter("kept").collect())
    assert len(ids["near_duplicates"]) == groups.select("component_id").distinct().count() < len(ids["language"])
    leaks = {r.doc_id for r in decontam.leaks(kept["near_duplicates"], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert sorted(ids["decontamination"]) == sorted(set(ids["near_duplicates"]) - leaks)
    rows = mixing.measured(kept["decontamination"])
    copies = mixing.applied(rows, mixing.plan(rows)).collect()
    assert sorted(ids["mix"]) == sorted(r.doc_id for r in copies for _ in range(r.copies))
    assert sorted(ids["token_ids"]) == sorted(ids["mix"])


def test_run_gives_the_rows_of_the_stages(spark, kept):
    # each row with the place of its text among equal ids is decided by the rows alone, so two runs agree
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, kept["token_ids"].collect()))


def test_odd_and_no_documents(spark, docs, tmp_path):
    rows = [(1, None), (2, ""), (3, "42"), (None, "a b c the of"), (4, "the of and house " * 20_000, "en", None), (5, "the of and house", "en"), (5, "the of and house", "en"), (6, "der die das haus", "de", "s")]
    for table, name in ((docs(rows).withColumns({"_row": F.lit(1), "hash": F.lit("x"), "start": F.lit(2)}), "odd"), (docs([]), "none")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "benchmark.parquet").symlink_to(f"{SF}/benchmark.parquet")
        table.write.parquet(str(folder / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).collect()
        assert {r.doc_id for r in out} <= {None, 4, 5, 6}
        assert bool(out) == (name == "odd")
