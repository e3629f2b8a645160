"""Exact duplicates by counting quotient filters, confirmed on the texts' bytes.

1. Every text, lower-cased in A-Z only, gets a 64-bit fingerprint and a
   SHA-256 (one native scan; a narrow table is written).
2. Each task builds counting quotient filters of its part's fingerprints, one
   for each shard (the fingerprints' top bits): the next bits are the quotient,
   the rest is a remainder kept in the quotient's run, with a count where it is
   over one.  Filters of a shard merge without loss: the remainders of a run are
   sorted, so fingerprints come back in order and equal ones add their counts.
   The number of shards grows with the rows, so a merge holds about
   ``2 ** SHARD_BITS`` of them; a fingerprint of very many rows is one slot of
   each filter.
3. Rows whose fingerprint counts one are unique and done.  The others' texts
   are read again and grouped by fingerprint, digest and the text itself, that
   is by comparing bytes; copies are combined in each task before the shuffle.

Cases: a null text is an empty one; empty texts are equal to each other.  Of a
group the row with the largest doc_id stays, a null doc_id being the smallest;
of repeated rows with that doc_id one stays.  Very long texts are compared
whole.  Different texts that share a fingerprint are told apart in step 3.  An
empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.tables import materialise

FINGERPRINT_BITS = 64
SHARD_BITS = 20          # a shard holds about 2 ** SHARD_BITS rows' fingerprints
FLUSH_ROWS = 1 << 20     # a task starts another filter after so many fingerprints

_U = np.uint64


def _low(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def _high(values: np.ndarray, keep: int, of: int) -> np.ndarray:
    """The top ``keep`` of ``of`` bits (a shift by all 64 bits is not defined in numpy)."""
    return np.zeros(len(values), _U) if keep == 0 else values >> _U(of - keep)


@dataclass
class QuotientFilter:
    """A counting quotient filter over ``bits``-bit fingerprints.

    ``occupied`` marks the quotients in use and ``run_end`` the last remainder
    of each run; ``counts`` holds the counts of the slots that ``repeated``
    marks.  Slots stand in order of quotient and remainder.
    """

    bits: int
    quotient_bits: int
    occupied: np.ndarray
    run_end: np.ndarray
    remainders: np.ndarray
    repeated: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From ascending distinct fingerprints and their counts."""
        q = min(bits, max(1, int(len(values) - 1).bit_length())) if len(values) else 0
        quotient = _high(values, q, bits).astype(np.int64)
        occupied = np.zeros(1 << q, dtype=bool)
        occupied[quotient] = True
        run_end = np.ones(len(values), dtype=bool)
        run_end[:-1] = quotient[1:] != quotient[:-1]
        repeated = counts > 1
        return cls(bits, q, occupied, run_end, values & _low(bits - q), repeated, counts[repeated].astype(np.int64))

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """The ascending fingerprints and their counts."""
        runs = np.concatenate([[0], np.cumsum(self.run_end)[:-1]]) if len(self.run_end) else np.zeros(0, np.int64)
        quotient = np.flatnonzero(self.occupied).astype(_U)[runs.astype(np.int64)]
        values = self.remainders if self.quotient_bits == 0 else (
            (quotient << _U(self.bits - self.quotient_bits)) | self.remainders)
        counts = np.ones(len(values), np.int64)
        counts[self.repeated] = self.counts
        return values, counts

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter of all fingerprints, equal ones with the sum of their counts."""
        parts = [f.fingerprints() for f in filters]
        return cls.build(*_summed(np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts])),
                         filters[0].bits)

    def to_bytes(self) -> bytes:
        width = -(-(self.bits - self.quotient_bits) // 8)
        slots = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = np.array([self.bits, self.quotient_bits, len(self.remainders), len(self.counts)], "<i8")
        return b"".join([head.tobytes(), np.packbits(self.occupied).tobytes(), np.packbits(self.run_end).tobytes(),
                         slots.tobytes(), np.packbits(self.repeated).tobytes(), self.counts.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        bits, q, n, m = (int(x) for x in np.frombuffer(data, "<i8", 4))
        at, width = 32, -(-(bits - q) // 8)

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q).astype(bool)
        run_end = np.unpackbits(take(-(-n // 8)), count=n).astype(bool)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = take(n * width).reshape(n, width)
        repeated = np.unpackbits(take(-(-n // 8)), count=n).astype(bool)
        return cls(bits, q, occupied, run_end, slots.reshape(-1).view("<u8").astype(_U), repeated,
                   take(8 * m).view("<i8").astype(np.int64))


def _summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values and the sums of their counts."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


# -- filters of a table -----------------------------------------------------------

def _filters(shard_bits: int):
    """Fingerprints of a task -> ``shard, filter`` rows."""
    rest = FINGERPRINT_BITS - shard_bits

    def cut(parts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(parts)
        values, counts = _summed(values, np.ones(len(values), np.int64))
        shard = _high(values, shard_bits, FINGERPRINT_BITS).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        end = np.append(begin[1:], len(values))
        low = values & _low(rest)
        made = [QuotientFilter.build(low[a:b], counts[a:b], rest).to_bytes() for a, b in zip(begin, end)]
        return pa.RecordBatch.from_arrays([pa.array(shard[begin]), pa.array(made, pa.binary())], ["shard", "filter"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(_U))
            n += len(held[-1])
            if n >= FLUSH_ROWS:
                yield cut(held)
                held, n = [], 0
        if n:
            yield cut(held)

    return rows


def fingerprint_counts(spark: SparkSession, prints: DataFrame, rows: int, fp: str = "_fp", least: int = 2) -> DataFrame:
    """``_fp, _n`` of the fingerprints that at least ``least`` of the ``rows`` rows have, through merged filters."""
    shard_bits = max(0, (max(rows, 1) - 1).bit_length() - SHARD_BITS)
    rest = FINGERPRINT_BITS - shard_bits

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        filters = [QuotientFilter.from_bytes(b) for b in group["filter"]]
        values, counts = QuotientFilter.merge(filters).fingerprints()
        found = counts >= least
        values, shard = values[found], int(group["shard"].iloc[0])
        full = values if rest == FINGERPRINT_BITS else values | (_U(shard) << _U(rest))
        return pd.DataFrame({"_fp": full.view(np.int64), "_n": counts[found]})

    built = prints.select(F.col(fp)).mapInArrow(_filters(shard_bits), "shard long, filter binary")
    return materialise(spark, built.groupBy("shard").applyInPandas(merged, "_fp long, _n long"), "quotient-counts")


# -- duplicates ---------------------------------------------------------------------

def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts in ASCII alone take the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), lower_ascii(F.coalesce(F.col(text), F.lit(""))).alias("_norm"))
    marked = source.withColumn("_fp", F.xxhash64("_norm"))
    digest = F.sha2("_norm", 256).alias("_sha")
    prints = materialise(spark, marked.select("doc_id", "_fp", digest), "exact-prints")
    repeated = fingerprint_counts(spark, prints, prints.count()).select("_fp")
    lone = prints.join(repeated, "_fp", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"))
    held = materialise(spark, marked.join(repeated, "_fp", "left_semi").select(
        "doc_id", "_fp", digest, "_norm", F.monotonically_increasing_id().alias("_row")), "exact-candidates")
    rank = F.coalesce("doc_id", F.lit(-(1 << 63)))
    classes = materialise(spark, held.groupBy("_fp", "_sha", "_norm").agg(
        F.max("doc_id").alias("keep_id"), F.max_by("_row", rank).alias("_kept_row"),
        F.count(F.lit(1)).alias("group_size")), "exact-classes")
    # the digest stands for the text unless two texts of one fingerprint share it
    shared = classes.groupBy("_fp", "_sha").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    key = ["_fp", "_sha"] if shared.isEmpty() else ["_fp", "_sha", "_norm"]
    grouped = held.select("doc_id", "_row", *key).join(classes.select(*key, "keep_id", "_kept_row", "group_size"), key).select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_kept_row")).alias("kept"), F.col("_sha").alias("text_sha256"))
    return lone.unionAll(grouped)
