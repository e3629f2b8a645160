"""Packing into length buckets whose boundaries minimise padding over the whole corpus.

1. Each document's length in tokens is taken once and written.  A document
   longer than ``max_length`` becomes pieces of ``max_length`` tokens and a rest.
2. The global histogram of piece lengths (at most ``max_length`` rows, however
   large the corpus) goes to the driver, where dynamic programming finds the
   ``buckets`` upper bounds with the least total padding; the result is optimal.
3. Inside a bucket of bound b a batch holds as many pieces as fit into
   ``token_budget`` when each is padded to b.  Pieces are dealt by hash over
   groups of ``GROUP_BATCHES`` batches, so no task ever holds a whole bucket;
   only the last batch of each group can be short.

The length is by default the number of words; any column of token counts can
be named instead.

Cases: a null or empty text (or null or negative token count) has length 0;
it keeps one row with null bucket, batch and slot, as there is nothing to pad;
rows that repeat a doc_id, or have a null one, are packed each on its own;
ties in hash order are broken by id and piece; with fewer distinct lengths
than buckets each length is its own bound; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.tables import materialise

GROUP_BATCHES = 32


@dataclass(frozen=True)
class PackingPlan:
    """Sizes of the packing."""

    max_length: int = 2048
    buckets: int = 16
    token_budget: int = 65_536
    max_pieces: int = 1024  # in one batch


def word_count(text: str) -> Column:
    """Number of words of a text, as a native column."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds, ascending, that minimise the sum of (bound - length) over all pieces.

    Each length goes to the smallest bound that is not below it.  Among equal
    costs fewer and smaller bounds win.
    """
    lengths = sorted(x for x, n in histogram.items() if n)
    if not lengths:
        return []
    v = np.array(lengths, dtype=np.int64)
    n = np.array([histogram[x] for x in lengths], dtype=np.int64)
    count = np.concatenate([[0], np.cumsum(n)])
    total = np.concatenate([[0], np.cumsum(n * v)])
    m = len(v)
    best = np.full(m + 1, 1 << 61, dtype=np.int64)  # more than any padding
    best[0] = 0
    cut = []
    for _ in range(min(buckets, m)):
        row, frm = best.copy(), [-1] * (m + 1)
        for j in range(1, m + 1):
            cost = best[:j] + v[j - 1] * (count[j] - count[:j]) - (total[j] - total[:j])
            k = int(np.argmin(cost))
            if cost[k] < row[j]:
                row[j], frm[j] = cost[k], k
        cut.append(frm)
        best = row
    bounds, j = [], m
    for frm in reversed(cut):
        if j and frm[j] >= 0:
            bounds.append(int(v[j - 1]))
            j = frm[j]
    return bounds[::-1]


def pack(spark: SparkSession, docs: DataFrame, plan: PackingPlan = PackingPlan(), doc_id: str = "doc_id",
         text: str = "text", tokens: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, first_token, n_tokens, bucket, bucket_length, batch, slot."""
    length = F.col(tokens).cast("long") if tokens else word_count(text)
    lengths = materialise(spark, docs.select(
        F.col(doc_id).alias("doc_id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).alias("n")), "lengths")
    piece = F.explode(F.sequence(F.lit(0).cast("long"),
                                 F.greatest(F.ceil(F.col("n") / plan.max_length) - 1, F.lit(0)).cast("long")))
    first = F.col("piece") * plan.max_length
    pieces = lengths.select("doc_id", "n", piece.alias("piece")).select(
        "doc_id", "piece", first.alias("first_token"),
        F.least(F.col("n") - first, F.lit(plan.max_length)).alias("n_tokens"))
    histogram = {r["n_tokens"]: r["count"] for r in  # at most max_length rows
                 pieces.filter("n_tokens > 0").groupBy("n_tokens").count().collect()}
    bounds = optimal_bounds(histogram, plan.buckets)
    if not bounds:
        none = F.lit(None)
        return pieces.select("*", none.cast("int").alias("bucket"), none.cast("long").alias("bucket_length"),
                             none.cast("string").alias("batch"), none.cast("int").alias("slot"))
    fits = [max(1, min(plan.max_pieces, plan.token_budget // b)) for b in bounds]
    held, low = [], 0
    for b in bounds:
        held.append(sum(n for x, n in histogram.items() if low < x <= b))
        low = b
    groups = [max(1, -(-h // (f * GROUP_BATCHES))) for h, f in zip(held, fits)]

    def of_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast("long") for x in values]), F.col("bucket") + 1)

    bucket = F.aggregate(F.array(*[F.lit(b) for b in bounds]), F.lit(0),
                         lambda a, b: a + (b < F.col("n_tokens")).cast("int"))
    dealt = pieces.filter("n_tokens > 0").withColumn("bucket", bucket) \
        .withColumn("_hash", F.xxhash64("doc_id", "piece")).withColumn("_group", F.pmod("_hash", of_bucket(groups)))
    rank = F.row_number().over(Window.partitionBy("bucket", "_group").orderBy("_hash", "doc_id", "piece")) - 1
    packed = dealt.withColumn("_rank", rank).withColumn("_fit", of_bucket(fits)).select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket", of_bucket(bounds).alias("bucket_length"),
        F.concat_ws("-", "bucket", "_group", F.floor(F.col("_rank") / F.col("_fit"))).alias("batch"),
        (F.col("_rank") % F.col("_fit")).cast("int").alias("slot"))
    empty = pieces.filter("n_tokens = 0").select(
        "doc_id", "piece", "first_token", "n_tokens", F.lit(None).cast("int").alias("bucket"),
        F.lit(None).cast("long").alias("bucket_length"), F.lit(None).cast("string").alias("batch"),
        F.lit(None).cast("int").alias("slot"))
    return packed.unionAll(empty)
