import __spark_entry__ as driver
import corpus_pipeline
from lendmark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(QUERIES)


def test_stages_keep_the_columns_and_take_effect(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    docs, sizes = before, [before.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.kept(stage(spark, docs, SF), "test-stage")
        assert docs.schema.simpleString() == before.schema.simpleString(), name
        assert docs.filter("n_chars <> length(text)").count() == 0
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] == sizes[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def test_stages_take_odd_rows_and_empty_tables(spark, docs, tmp_path):
    long = " ".join(f"word{k}" for k in range(3000))
    rows = [(None, None), (None, "a text without an id"), (3, ""), (3, None), (4, long), (4, long), (5, "b" * 60_000), (6, "mail a@b.example")]
    labels = spark.createDataFrame([(4, 1, None), (6, None, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (rows, []):
        at = docs(table)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = str(tmp_path / f"{len(table)}-{name.replace(' ', '-')}")
            stage(spark, at, str(tmp_path)).write.parquet(path)
            at = spark.read.parquet(path)
            assert set(at.columns) == set(docs([]).columns)
        assert corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).count() >= at.count()
