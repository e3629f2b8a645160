import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faresight.llm import exact_dedup as X
from faresight.llm.registry import op12_exact_dedup
from tests.conftest import SF_SMALL
from tests.llm.helpers import UPPER


def brute(rows):
    """doc_id, keep_id, group_size, kept, text_sha256 of ``(doc_id, text)`` rows."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(UPPER)].append(i)
    out = []
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        kept = False
        for i in ids:
            own = i == best and not kept
            kept = kept or own
            out.append((i, best, len(ids), own, digest))
    return Counter(out)


def result(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = result(op12_exact_dedup(spark, SF_SMALL))
    assert got == brute([tuple(r) for r in docs])
    assert any(r[2] > 1 for r in got)


def test_cases(spark):
    rows = [(1, "A b"), (2, "a B"), (2, "a b"), (None, "a b"), (3, None), (4, ""), (None, "lone"), (None, "two"), (None, "two"),
            (5, "É"), (6, "é"), (7, "É X"), (8, "É x"), (9, "w" * 300_000), (10, "W" * 300_000), (11, "İ"), (12, "i̇")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = df.withColumn("_fp", F.lit(1)).withColumn("_norm", F.lit("x")).withColumn("_row", F.lit(1)).withColumn("kept", F.lit(1))
    assert result(X.exact_duplicates(spark, clash)) == brute(rows)
    assert X.exact_duplicates(spark, df.limit(0)).count() == 0


def test_texts_that_share_a_fingerprint_are_told_apart(spark, monkeypatch):
    # every text gets one of four fingerprints, some the same digest too
    monkeypatch.setattr(X.F, "xxhash64", lambda c: F.length(c).cast("long") % 2)
    rows = [(i, "ab"[i % 2] * (i % 3 + 1)) for i in range(60)]
    assert result(X.exact_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_filters_and_shards(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)]
    rows = values + values[:1000] + [values[0]] * 2000
    df = spark.createDataFrame([(v,) for v in rows], "_fp long").repartition(9)
    for claimed in (len(rows), 64 << X.SHARD_BITS):      # one shard, and 64 shards
        got = {r["_fp"]: r["_n"] for r in X.fingerprint_counts(spark, df, claimed).collect()}
        assert got == {v: n for v, n in Counter(rows).items() if n > 1}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 12) - 1), max_size=40), min_size=1, max_size=5),
       st.sampled_from([12, 40, 64]))
def test_merge_is_lossless(parts, bits):
    spread = 0x9E3779B97F4A7C15
    lists = [[(v * spread) % (1 << 64) >> (64 - bits) for v in p] for p in parts]
    filters = []
    for p in lists:
        counted = sorted(Counter(p).items())
        f = X.QuotientFilter.build(np.array([v for v, _ in counted], np.uint64), np.array([c for _, c in counted], np.int64), bits)
        filters.append(X.QuotientFilter.from_bytes(f.to_bytes()))
    values, counts = X.QuotientFilter.merge(filters).fingerprints()
    assert dict(zip(values.tolist(), counts.tolist())) == Counter(v for p in lists for v in p)
    assert values.tolist() == sorted(values.tolist())
