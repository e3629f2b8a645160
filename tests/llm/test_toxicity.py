import zlib

import pytest

from faresight.llm import toxicity as T
from faresight.llm.registry import op10_toxicity
from tests.conftest import SF_CHECK


def auc(pairs):
    pos, neg = ([s for s, y in pairs if y == k] for k in (1, 0))
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    return op10_toxicity(spark, "/root/testdata/sf0.1").collect()


def test_held_out_accuracy(spark, scored):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    out = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert auc([(s, y) for s, y, _ in out]) > 0.85
    hits = sum(p and y for _, y, p in out)
    assert hits / max(1, sum(p for *_, p in out)) > 0.9 and hits / sum(y for _, y, _ in out) > 0.6
    assert abs(sum(s for s, *_ in out) - sum(y for _, y, _ in out)) < 0.25 * sum(y for _, y, _ in out)


def test_cases(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").limit(200)
    extra = spark.createDataFrame([(None, "you idiot"), (-1, None), (-2, ""), (-3, "word " * 50_000), (-3, "word")], docs.schema)
    docs = docs.unionAll(extra).selectExpr("doc_id", "text", "1 as score", "2 as features", "'k' as label")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", "toxic")
    labels = labels.unionAll(spark.createDataFrame([(None, 1), (0, None), (1, 1), (1, 1)], labels.schema))
    got = T.toxicity_scores(spark, docs, labels).collect()
    assert len(got) == 205 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    kept = T.drop_toxic(spark, docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in got)
    assert {(r["score"], r["features"], r["label"]) for r in kept.collect()} == {(1, 2, "k")}
    assert T.toxicity_scores(spark, docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("toxic, score", [([], 0.5), ([0, 0, 0], 0.125), ([1, 1, 1], 0.875)])
def test_without_labels_of_both_classes_scores_are_the_prior(spark, toxic, score):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:len(toxic)]
    docs = spark.createDataFrame([(i, "some words") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame(list(zip(ids, toxic)), "doc_id long, toxic long")
    assert {r["score"] for r in T.toxicity_scores(spark, docs, labels).collect()} == {score}


def test_held_out_labels_are_never_read(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", "toxic")
    sample = T.labelled_sample(docs, labels, T.ToxicityModel(max_sample=50)).collect()
    assert len(sample) == 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in sample)


def test_features():
    lexicon = {"idiot": 2.0, "^worthl": 1.0}
    f = T.features("You are an IDIOT and worthless!! st*pid id1ot soooo", lexicon)
    assert f[2] > 1 and f[3] == 2.0 and f[6] > 0 and f[11] > 0 and f[12] > 0 and f[13] > 0
    assert T.features(None, lexicon) == T.features("", lexicon) == T.features("123 ..", lexicon) == [0.0] * 14
    assert len(T.features("plain words", {})) == 14


def test_disguised_words_of_a_very_long_text_count():
    short, long = ("st*pid 1d10t plainword " * n for n in (10, 10_000))
    lexicon = {"stpid": 2.0, "idiot": 2.0}
    for text in (short, long):
        assert len(text.split()) == (30 if text is short else 30_000)
    a, b = T.features(short, lexicon), T.features(long, lexicon)
    assert b[13] > a[13] > 0  # log of the hits
    assert a[0] == b[0] == 0.0  # no plain hit
    assert T.features("x1y " * 30_000, lexicon)[12] > 0  # the rate, too
