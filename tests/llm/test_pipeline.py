import duckdb
import pytest
from collections import Counter

import __spark_entry__ as E
import corpus_pipeline
from faresight.llm import registry
from faresight.session import scratch_path
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import WORD
from tests.llm.test_near_dedup import brute
from tests.llm.test_passages import P
from tests.llm.test_quality_rules import verdicts
from tools.check_oracle import rows_of


def test_registration():
    names = set(E.queries())
    assert "pipeline" in names and "pipeline" not in E.oracle_sql()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


@pytest.mark.parametrize("key", sorted(registry.SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    rel = con.sql(registry.SQL[key])
    df = registry.QUERIES[key](spark, SF_CHECK)
    assert sorted(df.columns) == sorted(rel.columns)
    assert Counter(rows_of(df.columns, [tuple(r) for r in df.collect()])) == Counter(rows_of(rel.columns, rel.fetchall()))


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, state = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        state[name] = before, after = docs, spark.read.parquet(path)
        if name != "packing":
            assert after.columns == columns
        docs = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_dedup", "substring_dedup", "packing"]

    def ids(df):
        return {r["doc_id"] for r in df.select("doc_id").collect()}

    before, after = state["quality_rules"]
    rows = [tuple(r) for r in before.select("doc_id", "text", "source").collect()]
    assert ids(after) == {v[0] for v in verdicts(rows, registry.quality_rules.QualityLimits()) if v[-1]}
    before, after = state["toxicity"]
    assert ids(after) <= ids(before) and after.exceptAll(before).isEmpty()
    before, after = state["near_dedup"]
    groups = brute({r["doc_id"]: r["text"] for r in before.collect()})
    assert ids(after) == {i for i, (_, first) in groups.items() if i == first} and after.exceptAll(before).isEmpty()
    before, after = state["substring_dedup"]
    assert ids(after) == ids(before) == {r["doc_id"] for r in P.dedup_passages(spark, before).collect()}
    packed, after = state["packing"][1].collect(), state["packing"][0].collect()
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["n_tokens"]
    assert total == Counter({r["doc_id"]: len(WORD.findall(r["text"])) for r in after})


def test_run_on_an_empty_table(spark, tmp_dir):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_dir}/{t}.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []
