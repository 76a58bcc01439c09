"""Each stage against its operator's rows, which the other tests hold against
brute force; and the registered queries."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from parcelight.llm import mixing, near_copies, neighbours, quality_rules
from parcelight.llm.common import remainder
from parcelight.llm.queries import ORACLE, QUERIES
from workload.check import connect, rows_of

from .conftest import SCHEMA, odd_rows, prose, row

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean prose, junk, exact copies and odd rows, with labels."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(300):
        text, bad = prose(rng, rng.randint(60, 120)), i % 7 == 3
        if bad:
            text = text.replace(" ", "### ")
        if i % 10 == 9:
            text = rows[-1][1]  # a copy of the document before
        rows.append(row(i, text, "en", f"s{i % 3}"))
        labels.append((i, 0 if "###" in text else 1, 0))
    rows += [(r[0] and r[0] + 1000, *r[1:]) for r in odd_rows()]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).select(COLUMNS).repartition(4).write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    return path


def _ids(df):
    return sorted(map(str, (r.doc_id for r in df.select("doc_id").collect())))


def test_stages(spark, folder):
    assert [type(s) for s in corpus_pipeline.STAGES] == [tuple] * 5
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(remainder("doc_id", 5) != 0)
    out = STAGES["quality classifier"](spark, docs, folder)
    model = neighbours.fit(docs, labels)
    good = neighbours.with_score(docs, model, "text", "s").where("s >= 0.3")
    assert out.columns == COLUMNS and _ids(out) == _ids(good)
    junk = {r.doc_id for r in docs.where("text LIKE '%###%'").collect()}
    kept = {r.doc_id for r in out.collect()}
    assert not junk & kept
    assert {r.doc_id for r in docs.where("doc_id < 300").collect()} - junk <= kept

    out = STAGES["quality rules"](spark, docs, folder)
    assert out.columns == COLUMNS
    assert _ids(out) == _ids(quality_rules.quality_rules(docs).where("kept"))

    out = STAGES["SimHash near-dedup"](spark, docs, folder)
    assert out.columns == COLUMNS
    found = near_copies.with_components(docs).where("id = first_id").select(F.col("id").alias("doc_id"))
    assert sorted(set(_ids(out)) - {"None"}) == sorted(set(_ids(found)))

    out = STAGES["mixing sources to target weights"](spark, docs, folder)
    order = {r.text: r.mix_order for r in mixing.mix(docs).collect()}
    assert out.columns == COLUMNS and _ids(out) == _ids(docs)
    places = [order[r.text] for r in out.dropDuplicates(["text"]).collect()]
    assert len(places) == len(order)

    out = STAGES["BPE encoding and decoding"](spark, docs, folder)
    assert _ids(out) == _ids(docs) and "ids" in out.columns


def test_result_has_the_mixed_order(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = STAGES["mixing sources to target weights"](spark, docs, folder)
    mixed.write.option("maxRecordsPerFile", 40).parquet(f"{tmp_path}/mixed")  # several files
    stored = spark.read.parquet(f"{tmp_path}/mixed")
    out = STAGES["BPE encoding and decoding"](spark, stored, folder).collect()
    assert sorted(r.mix_order for r in out) == list(range(docs.count()))
    expect = [r.doc_id for r in mixing.mix(docs).orderBy("mix_order").collect()]
    assert [r.doc_id for r in sorted(out, key=lambda r: r.mix_order)] == expect


def test_whole_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in out}
    assert len(out) == len(ids)
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 300")
    first, clean = {}, set()
    for r in docs.orderBy("doc_id").collect():
        if "###" not in r.text:
            clean.add(first.setdefault(r.text, r.doc_id))
    assert {i for i in ids if i is not None and i < 300} == clean
    assert all(len(r.ids) == r.n_tokens for r in out)


def test_stages_of_nothing(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for stage in STAGES.values():
        assert stage(spark, none, folder).count() == 0


def test_registered():
    assert sorted(QUERIES) == sorted(
        n for n in contract.queries() if n.startswith("op") and n[2].isdigit())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert "pipeline" in contract.queries()
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = contract.queries()[name](spark, SF)
    key = {"op5_url_filter": "pages", "op10_code_search": None, "op11_spelling": None, "op13_conversation_repair": None}.get(name, "documents")
    if name in ORACLE:
        assert compare_with_sql(name, df) == ""
    if key:
        assert df.count() == spark.read.parquet(f"{SF}/{key}.parquet").count()


def compare_with_sql(name, df):
    found = connect(SF).execute(ORACLE[name])
    names = [d[0] for d in found.description]
    left, right = rows_of(df.columns, df.collect()), rows_of(names, found.fetchall())
    return "" if left == right else str([p for p in zip(left, right) if p[0] != p[1]][:2])
