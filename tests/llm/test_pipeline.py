import duckdb
import pytest

import corpus_pipeline
from copyaudit.llm import byte_cnn, line_dedup, mixing, packing, queries, simhash
from copyaudit.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql_agree(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    key = lambda row: tuple((x is None, str(x)) for x in row)
    want = sorted((tuple(r[columns.index(c)] for c in order) for r in cursor.fetchall()), key=key)
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=key) == want


def test_stages_take_effect_and_pass_on_whole_rows(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    network = byte_cnn.fit(docs, table(spark, SF, "labels"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert out.columns == columns
        if name == "quality_classifier":
            good = {r.doc_id for r in byte_cnn.score(docs, network).where("score >= 0.7").collect()}
            assert {r.doc_id for r in out.collect()} == good
        if name == "line_dedup":
            lines = [x for r in out.collect() for x in r.text.split("\n") if len(x) >= line_dedup.MIN_CHARS and x.strip()]
            assert len(lines) == len(set(lines))
        if name == "simhash_near_dedup":
            assert out.count() == simhash.near_duplicates(docs).select("component_id").distinct().count()
        if name == "mix_sources":
            chosen = mixing.mix_documents(docs)
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in chosen.collect())
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(r.length for r in packed) == sum(r.length for r in packing.pieces(docs).collect())


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 50 and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]


def test_awkward_rows_through_all_stages(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0
