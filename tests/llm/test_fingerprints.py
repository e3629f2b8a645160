import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import fingerprints as P
from faresight.llm.registry import op1_fingerprints
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, jaccard, shingles

DDL = "doc_id long, text string, fingerprint int"


def test_query_against_brute_force(spark):
    docs = documents(spark, SF_SMALL)
    order = sorted(docs, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    got = {r["doc_id"]: r for r in op1_fingerprints(spark, SF_SMALL).collect()}
    assert set(got) == set(docs)
    errors = []
    for i, r in got.items():
        text, following = docs[i]["text"] or "", docs[after[i]]["text"] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        errors.append(r["near_edited"] - jaccard(shingles(text), shingles(edited)))
        errors.append(r["near_next"] - jaccard(shingles(text), shingles(following)))
        assert r["fingerprint"] == P.fingerprints([text])[0]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_estimate_is_unbiased_for_short_and_long_texts():
    rng = np.random.default_rng(1)
    for n in (12, 200, 5000):
        errors = []
        for _ in range(20):
            w = [f"w{x}" for x in rng.integers(0, 10**6, n)]
            other = w[: 2 * n // 3] + [f"v{x}" for x in rng.integers(0, 10**6, n - 2 * n // 3)]
            a, b = " ".join(w), " ".join(other)
            x, y = P.fingerprints([a, b])
            errors.append(P.likeness(x, y) - jaccard(shingles(a), shingles(b)))
        assert abs(np.mean(errors)) < 0.06


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_packing_keeps_the_low_bits(bits):
    plan = P.FingerprintPlan(bins=64, bits=bits)
    a, b = P.fingerprints([" ".join(f"{x}{k}" for k in range(400)) for x in "ab"], plan)
    assert len(a) == 64 * bits // 4 == len(b)
    assert P.likeness(a, a, plan) == 1.0 and P.likeness(a, b, plan) < 0.5


def test_empty_bins_copy_the_first_full_bin_of_their_order():
    plan = P.FingerprintPlan(bins=64)
    some = np.array([5 << 58, (9 << 58) + 1, (9 << 58) + 7], dtype=np.uint64)
    values = P.bin_values(some, plan)
    orders = P._bin_orders(64)
    for i in range(64):
        donor = i if i in (5, 9) else next(b for b in orders[i] if b in (5, 9))
        assert values[i] == values[donor]
    assert values[9] == P.mix64(some[1:2])[0]


def test_cases(spark):
    rows = [(1, "a b c d e f g", 0), (2, None, 0), (3, "", 0), (3, "a b c d e f g", 1), (None, "x", 0), (7, "x", 0),
            (7, "x", 0), (9, " \n ", 0), (10, "ä" * 5001 + " " + "w " * 4000, 0)]
    docs = spark.createDataFrame(rows, DDL)
    got = P.compare_with_edits(spark, docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["fingerprint"] == "" and by[9][0]["fingerprint"] == ""
    assert by[2][0]["n_chars"] == 0 and by[10][0]["n_chars"] == 5002 + 8000
    assert by[1][0]["fingerprint"] == max(r["fingerprint"] for r in by[3])
    # null comes last, so its next document is the first (largest) one
    assert by[None][0]["edited_sha256"] == hashlib.sha256(b"x").hexdigest()
    # 2's next document is 1
    assert by[2][0]["near_next"] == 0.0
    # two rows of 7, one after the other
    assert sorted(r["near_next"] for r in by[7])[-1] == 1.0


def test_one_row_and_none(spark):
    one = P.compare_with_edits(spark, spark.createDataFrame([(4, "one two three four five six", 0)], DDL)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    none = P.compare_with_edits(spark, spark.createDataFrame([], DDL))
    assert none.collect() == [] and "near_edited" in none.columns


def test_order_holds_over_many_ranges(spark):
    docs = spark.range(500).select((F.col("id") * 37 % 1000).alias("doc_id"),
                                   F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts, reverse=True)
    for r in P.compare_with_edits(spark, docs).collect():
        t, n = texts[r["doc_id"]], texts[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        assert r["edited_sha256"] == hashlib.sha256(P.edited_text(t, n).encode()).hexdigest()


def test_add_fingerprints_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (2, None, 6)], "doc_id long, text string, bins int")
    got = P.add_fingerprints(docs).orderBy("doc_id").collect()
    assert [r["bins"] for r in got] == [5, 6] and got[1]["fingerprint"] == ""
