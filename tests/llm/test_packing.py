import itertools
import random
from collections import Counter, defaultdict

from faresight.llm import packing as K
from faresight.llm.registry import op8_packing
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, words


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_bounds_are_optimal():
    rng = random.Random(5)
    for _ in range(60):
        histogram = {rng.randint(1, 30): rng.randint(1, 50) for _ in range(rng.randint(1, 8))}
        buckets = rng.randint(1, 4)
        bounds = K.optimal_bounds(histogram, buckets)
        assert len(bounds) <= buckets and bounds[-1] == max(histogram)
        best = min(padding(histogram, [*c, max(histogram)]) for k in range(buckets)
                   for c in itertools.combinations(sorted(histogram), min(k, len(histogram))))
        assert padding(histogram, bounds) == best


def test_query(spark):
    docs = documents(spark, SF_SMALL)
    plan = K.PackingPlan()
    rows = op8_packing(spark, SF_SMALL).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["first_token"], r["n_tokens"]))
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        n, want = len(words(docs[i]["text"])), []
        for k in range(max(1, -(-n // plan.max_length))):
            want.append((k, k * plan.max_length, min(plan.max_length, n - k * plan.max_length)))
        assert sorted(own) == want
    lengths = Counter(r["n_tokens"] for r in rows if r["n_tokens"])
    bounds = K.optimal_bounds(lengths, plan.buckets)
    batches = defaultdict(list)
    for r in rows:
        if r["n_tokens"]:
            assert r["bucket_length"] == min(b for b in bounds if b >= r["n_tokens"]) == bounds[r["bucket"]]
            batches[r["bucket"], r["batch"]].append(r["slot"])
        else:
            assert r["bucket"] is None and r["batch"] is None
    for (bucket, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) * bounds[bucket] <= plan.token_budget


def test_cases(spark):
    rows = [(1, None, 3), (2, "", 3), (None, "a b", 3), (3, "a b c", 3), (3, "a b c", 3), (4, "w " * 4100, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    got = K.pack(spark, docs).collect()
    assert len(got) == 8
    assert sum(r["n_tokens"] for r in got) == 2 + 3 + 3 + 4100
    assert [r["bucket"] for r in got if r["doc_id"] in (1, 2)] == [None, None]
    assert K.pack(spark, docs.limit(0)).collect() == []
    assert [r["batch"] for r in K.pack(spark, docs.filter("doc_id = 1")).collect()] == [None]
    own = K.pack(spark, docs.filter("doc_id is not null"), tokens="bucket").collect()
    assert {r["n_tokens"] for r in own} == {3}


def test_a_bucket_is_divided_among_groups(spark):
    plan = K.PackingPlan(max_length=8, buckets=2, token_budget=16)
    docs = spark.range(3000).selectExpr("id as doc_id", "'a b c d' as text")
    rows = K.pack(spark, docs, plan).collect()
    sizes = Counter(r["batch"] for r in rows)
    assert max(sizes.values()) == 4 and sum(sizes.values()) == 3000
    groups = Counter(r["batch"].rsplit("-", 1)[0] for r in rows)
    assert len(groups) > 10 and max(groups.values()) < 3 * 3000 / len(groups)
    assert sum(n < 4 for n in sizes.values()) <= len(groups)
