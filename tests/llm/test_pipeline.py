"""The pipeline's stages, each against what its operator says, and the registered queries."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from demandspark.llm.mixing import mix_sources, taken_words
from demandspark.llm.near_dedup import near_duplicates
from demandspark.llm.quality import judged
from demandspark.llm.substring_dedup import kept_words

from tests.llm.data import SF, both, edge_docs, words


def test_every_operator_is_registered():
    names = [k for k in E.queries() if k.startswith("op") or k == "pipeline"]
    assert sorted({int(k[2:].split("_")[0]) for k in names if k != "pipeline"}) == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("key", sorted(E.oracle_sql().keys() & {k for k in E.queries() if k.startswith("op")}))
def test_oracles(spark, key):
    from tools.oracle_check import compare, duck

    r = compare(E.queries()[key](spark, SF), E.oracle_sql()[key], duck(SF))
    assert r["exact"] and not r["type_mismatch"], r


@pytest.mark.parametrize("which", [both, edge_docs])
def test_stages(spark, tmp_path, which):
    docs = which(spark)
    columns = docs.columns

    def written(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    one = written("quality", cp.quality_rules(spark, docs, SF))
    assert one.columns == columns and one.count() == judged(docs).where("kept").count()

    two = written("near", cp.near_dedup(spark, one, SF))
    kept = {r.doc_id for r in near_duplicates(one).where("kept and doc_id is not null").collect()}
    ids = [r.doc_id for r in two.where("doc_id is not null").collect()]
    assert two.columns == columns and len(ids) == len(set(ids)) and set(ids) == kept
    assert two.where("doc_id is null").count() == one.where("doc_id is null").count()

    three = written("substring", cp.substring_dedup(spark, two, SF))
    left = {(r.doc_id, r.n_words - r.n_removed) for r in kept_words(two).collect() if r.n_words > r.n_removed}
    assert three.columns == columns and {(r.doc_id, len(words(r.text))) for r in three.collect()} == left

    four = written("mix", cp.source_mix(spark, three, SF))
    taken = {r.doc_id: r.n for r in taken_words(mix_sources(three)).groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0").collect()}
    got = {}
    for r in four.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
    assert four.columns == columns and got == taken

    five = written("bpe", cp.bpe_encoding(spark, four, SF))
    assert five.count() == four.count() and five.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty_pipeline(spark, tmp_path):
    docs = edge_docs(spark).limit(0)
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_run(spark):
    assert cp.run(spark, SF).count() > 0
