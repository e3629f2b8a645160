"""Document fingerprints: one-permutation MinHash with optimal densification.

Each 5-word shingle is hashed once.  The hash's upper bits choose one of
``bins`` bins and the smallest rest in a bin is its value.  An empty bin copies
the first non-empty bin of its own fixed random order of bins (optimal
densification), so even a text with a single shingle has a full signature.
The low ``bits`` bits of each value are packed.  Unequal values agree in b bits
with a chance of 2**-b, so likeness is estimated from the share p of agreeing
bins as (p - 2**-b) / (1 - 2**-b), not below 0.

Following documents: rows are dealt by ranges of doc_id (bounds from an
approximate quantile sketch), sorted within their range, and streamed; only
each range's first row is sent a second time, to the end of the range before.
The texts are shuffled once and no task holds more than one batch of a range.

Cases: a null text is an empty one; a text without words has the empty
fingerprint ``''``, which is like another empty one (1.0) and unlike any other
(0.0); a text with one to four words has one shingle; equal texts have equal
fingerprints; rows that repeat a doc_id follow each other in the order of
their texts' hash and text; null doc_ids come last in descending order; a
single row is its own next document; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.text import Words, groups, mix64, random_words

LOWEST = -(1 << 63)  # stands for a null doc_id
FIRST_LOOK = 16


@dataclass(frozen=True)
class FingerprintPlan:
    """Size of a fingerprint: ``bins`` (a power of two) of ``bits`` (1, 2, 4 or 8) bits."""

    bins: int = 512
    bits: int = 4


@cache
def _bin_orders(bins: int) -> np.ndarray:
    """For each bin a fixed random order of all bins."""
    keys = random_words(bins * bins, 71).reshape(bins, bins)
    return np.argsort(keys, axis=1, kind="stable").astype(np.int16)


def bin_values(shingles: np.ndarray, plan: FingerprintPlan) -> np.ndarray:
    """Densified values of all bins; ``shingles`` are 64-bit hashes, at least one."""
    shift = np.uint64(64 - plan.bins.bit_length() + 1)
    ordered = np.sort(shingles)
    where = (ordered >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
    values = np.zeros(plan.bins, dtype=np.uint64)
    full = np.zeros(plan.bins, dtype=bool)
    values[where[first]] = mix64(ordered[first])
    full[where[first]] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        orders = _bin_orders(plan.bins)
        near = full[orders[empty, :FIRST_LOOK]]
        donor = orders[empty, near.argmax(axis=1)]
        late = np.flatnonzero(~near.any(axis=1))
        if len(late):
            donor[late] = orders[empty[late], full[orders[empty[late]]].argmax(axis=1)]
        values[empty] = values[donor]
    return values


def _packed(values: np.ndarray, plan: FingerprintPlan) -> str:
    low = (values & np.uint64((1 << plan.bits) - 1)).astype(np.uint8)
    per_byte = 8 // plan.bits
    out = np.zeros(plan.bins // per_byte, dtype=np.uint8)
    for j in range(per_byte):
        out |= low[j::per_byte] << np.uint8(j * plan.bits)
    return out.tobytes().hex()


def fingerprints(texts, plan: FingerprintPlan = FingerprintPlan()) -> list[str]:
    """Fingerprints of texts, as hexadecimal strings of equal length ('' without words)."""
    out = []
    for _, encoded in groups(texts):
        hashes, bounds = Words(encoded).shingles()
        for i in range(len(encoded)):
            own = hashes[bounds[i]:bounds[i + 1]]
            out.append(_packed(bin_values(own, plan), plan) if len(own) else "")
    return out


def likeness(a: str, b: str, plan: FingerprintPlan = FingerprintPlan()) -> float:
    """Estimated Jaccard similarity of two texts' shingle sets, from 0 to 1."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    differ = np.frombuffer(bytes.fromhex(a), dtype=np.uint8) ^ np.frombuffer(bytes.fromhex(b), dtype=np.uint8)
    mask, per_byte = np.uint8((1 << plan.bits) - 1), 8 // plan.bits
    agree = sum(int((((differ >> np.uint8(j * plan.bits)) & mask) == 0).sum()) for j in range(per_byte)) / plan.bins
    chance = 2.0 ** -plan.bits
    return max(0.0, (agree - chance) / (1 - chance))


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def add_fingerprints(docs: DataFrame, plan: FingerprintPlan = FingerprintPlan(), text: str = "text",
                     name: str = "fingerprint") -> DataFrame:
    """``docs`` with a column ``name`` of fingerprints; no shuffle."""
    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts, plan), dtype=object)

    return docs.withColumn(name, made(F.coalesce(F.col(text), F.lit(""))))


def _compared(plan: FingerprintPlan):
    """Rows of one range in order, the next range's first row at its end, to results."""
    def results(ids: list, texts: list[str], after: str) -> pa.RecordBatch:
        following = [*texts[1:], after]
        edited = [edited_text(a, b) for a, b in zip(texts, following)]
        own = fingerprints([*texts, after], plan)
        changed = fingerprints(edited, plan)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], pa.string()),
            pa.array(own[:-1], pa.string()), pa.array(changed, pa.string()),
            pa.array([likeness(a, b, plan) for a, b in zip(own, changed)], pa.float64()),
            pa.array([likeness(a, b, plan) for a, b in zip(own, own[1:])], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text, tail in zip(*(batch.column(c) for c in ("doc_id", "_text", "_tail"))):
                text = text.as_py()
                if tail.as_py():
                    if texts:  # the first tail row ends its range
                        yield results(ids, texts, text)
                    ids, texts, size = [], [], 0
                    continue
                if texts and size > 1 << 20:
                    yield results(ids, texts, text)
                    ids, texts, size = [], [], 0
                ids.append(doc_id.as_py())
                texts.append(text)
                size += len(text)

    return rows


def compare_with_edits(spark: SparkSession, docs: DataFrame, plan: FingerprintPlan = FingerprintPlan(),
                       doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    The edited text takes the beginning of the next document in descending
    doc_id (after the last: the first) in place of its own last half.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else F.array(F.lit(1.0))
    bounds = np.unique(np.array(
        docs.agg(F.percentile_approx(key, shares, max(10_000, 20 * parts))).first()[0] or [], dtype=np.int64))

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:  # part 0 holds the largest ids
        return pd.Series(len(bounds) - np.searchsorted(bounds, keys.to_numpy(dtype=np.int64), side="left")).astype("int32")

    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                        key.alias("_key"), part_of(key).alias("_part"))
    # One row for each range: at most as many as there are partitions.
    ranges = sorted(docs.select(key.alias("_key"), part_of(key).alias("_part")).groupBy("_part").agg(F.max("_key")).collect())
    before = {int(head): int(ranges[i - 1][0]) for i, (_, head) in enumerate(ranges)}
    if not before:
        return dealt.limit(0).mapInArrow(_compared(plan), _RESULT)
    heads = F.create_map(*[F.lit(x).cast(t) for pair in before.items() for x, t in zip(pair, ("long", "int"))])
    copies = F.array_compact(F.array(
        F.struct("_part", F.lit(False).alias("_tail")),
        F.when(F.col("_key").isin(list(before)), F.struct(heads[F.col("_key")].alias("_part"), F.lit(True).alias("_tail")))))
    sent = dealt.withColumn("_copy", F.explode(copies)).select("doc_id", "_text", "_key", "_copy.*")
    ordered = sent.repartitionById(len(bounds) + 1, F.col("_part")).sortWithinPartitions(
        "_part", "_tail", F.desc("_key"), F.xxhash64("_text"), "_text")
    return ordered.select("doc_id", "_text", "_tail").mapInArrow(_compared(plan), _RESULT)


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
