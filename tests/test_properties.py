"""Property tests: distributed operators against brute force in Python."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from faresight.functions.columns import exact_mean
from faresight.operators import sessions

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def brute_sessions(rows, gap_s):
    out = []
    by_key = {}
    for k, t in rows:
        by_key.setdefault(k, []).append(t)
    for k, ts in by_key.items():
        ts.sort()
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if (t - prev).total_seconds() > gap_s:
                out.append((k, start, prev + dt.timedelta(seconds=gap_s), n))
                start, n = t, 0
            prev = t
            n += 1
        out.append((k, start, prev + dt.timedelta(seconds=gap_s), n))
    return sorted(out)


offsets = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4 * 3600 * 1000)), min_size=1, max_size=60)


@SETTINGS
@given(offsets, st.sampled_from([60, 300, 3600]))
def test_bucketed_sessions_match_brute_force(spark, rows, gap_s):
    data = [(k, T0 + dt.timedelta(milliseconds=ms)) for k, ms in rows]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz")
    got = sessions.session_counts(df, ["k"], "t", f"{gap_s} seconds")
    assert sorted(tuple(r) for r in got.collect()) == brute_sessions(data, gap_s)


@SETTINGS
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=40), st.integers(0, 4))
def test_exact_mean_matches_decimal(spark, cents, out_scale):
    vals = [Decimal(c) / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(18,2)")
    mean = sum(vals) / len(vals)
    q = Decimal(1).scaleb(-out_scale)
    want = abs(mean).quantize(q, rounding=ROUND_HALF_UP) * (1 if mean >= 0 else -1)
    assert df.agg(exact_mean("x", 2, out_scale)).first()[0] == want


ids = st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f"]), min_size=0, max_size=12)


@FEW
@given(ids, ids, st.booleans())
def test_merge_matches_model(spark, target_ids, source_ids, dedupe):
    from collections import Counter

    from faresight.sinks.merge import merged
    tgt = spark.createDataFrame([(k, "t", i) for i, k in enumerate(target_ids)],
                                "unique_row_id string, filename string, n int")
    src = spark.createDataFrame([(k, "s", i) for i, k in enumerate(source_ids)],
                                "unique_row_id string, filename string, n int")
    got = Counter((r.unique_row_id, r.filename) for r in merged(src, tgt, dedupe_source=dedupe).collect())
    want = Counter((k, "t") for k in target_ids)
    new = [k for k in source_ids if k not in set(target_ids)]
    if dedupe:
        new = list(dict.fromkeys(new))
    want.update((k, "s") for k in new)
    assert got == want


@FEW
@given(st.lists(st.tuples(st.sampled_from(["1", "2", None]), st.integers(0, 3), st.integers(0, 10**6)),
                min_size=1, max_size=30, unique_by=lambda x: x[2]))
def test_dedupe_keeps_min_tiebreak_per_key(spark, rows):
    from faresight.operators.staging import dedupe_first
    df = spark.createDataFrame(rows, "vendorid string, minute int, k int")
    key = lambda t: (t[0] or "", t[1], t[2])
    got = sorted((tuple(r) for r in dedupe_first(df, ["vendorid", "minute"], [F.col("k")]).collect()), key=key)
    best = {}
    for v, m, k in rows:
        best[(v, m)] = min(best.get((v, m), k), k)
    want = sorted(((v, m, k) for (v, m), k in best.items()), key=key)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=3))
def test_histogram_percentiles_equal_spark_percentile(spark, rows, ps):
    from faresight.operators.models import exact_percentiles
    rows = rows + [(9, None)]                      # a group with only NULLs -> NULL percentile
    df = spark.createDataFrame(rows, "g int, x int")
    names = [f"q{i}" for i in range(len(ps))]
    got = {r.g: tuple(r[n] for n in names) for r in exact_percentiles(df, ["g"], "x", ps, names).collect()}
    want_df = df.groupBy("g").agg(*[F.percentile(F.col("x").cast("double"), p).alias(n) for p, n in zip(ps, names)])
    want = {r.g: tuple(r[n] for n in names) for r in want_df.collect()}
    assert got.keys() == want.keys()
    for g in want:
        for a, b in zip(got[g], want[g]):
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(b))
