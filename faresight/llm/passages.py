"""Substring dedup: paragraphs in MinHash bands, removals by component.

A paragraph is looked at on two levels, so that passages are found whether
they fill a line or stand in the middle of one:

* A line of ``min_line_words`` words or more is a paragraph for near copies.
  Bands are tuned for recall (12 bands of 3 values: a pair at Jaccard 0.75
  shares none with a chance of 0.14 %); colliding lines are verified on their
  full sets of 5-word shingles and clustered by connected components.  The
  first line (smallest doc_id, then place) of a component stays.
* Every line is divided after sentence ends (and, in sentences of more than 40
  words, at word pairs chosen by hash, so that both copies are cut alike).
  Such a short paragraph counts as repeated if an equal one occurs in a
  document with a smaller doc_id: one band that holds the whole set, as at this
  length a single other word brings the similarity below 0.75.  Sentences of
  fewer than ``min_sentence_words`` words do not part two repeated ones.
* A passage cut out of sentences shows in its seeds: of every ``SEED`` neighbouring
  windows of ``SEED`` words the one with the smallest hash (all that tie).  The choice
  depends on these words alone, so a run of 2 * SEED - 1 = 25 words has a seed
  that is one in its other copy too, and the seeds inside a common run touch or
  overlap.  A seed that a document with a smaller doc_id has marks its words.
  At most SEED - 1 words at each end of a common run lie outside of its seeds.

Marked words next to each other, by sentences or seeds, form a run, and runs of
``min_run_words`` words or more are removed; so a passage of 44 words or more
that a smaller doc_id has is always found, wherever it was cut.

The occurrence in the smallest doc_id always stays.  Repeats within one
document are not removed.  Sentences and seeds are cut and shuffled once; of
equal ones in a group of about a megabyte of texts only the first document's
meet those of other groups.

Cases: a null text stays null, an empty one empty; a text may become empty;
rows that repeat a doc_id are one document, so they lose nothing to each
other; a row with a null doc_id is returned as it is and removes nothing
elsewhere; an empty table gives an empty result; other columns are kept as
they are whatever their names (``n_chars``, if present, is set anew for
changed texts).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from faresight.llm.near_dedup import SALTS, Banding, near_duplicates
from faresight.llm.tables import materialise
from faresight.llm.text import Words, groups, mix64, random_words

LONG_SENTENCE = 40
CUT_EVERY = 12
SEED = 13
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True
_MULT, _PAIR = (int(x) | 1 for x in random_words(2, 31))
_MULT_INVERSE = pow(_MULT, -1, 1 << 64)


@dataclass(frozen=True)
class PassagePlan:
    """Lengths in words and the bands; see the module's text."""

    min_line_words: int = 40
    min_sentence_words: int = 5
    min_run_words: int = 20
    bands: Banding = Banding(rows=3, bands=12, look=12)


class Sentences:
    """Lines and sentences of a group of texts, as ranges of its words."""

    def __init__(self, encoded: list[bytes]):
        self.words = w = Words(encoded)
        n = len(w.start)
        newlines = np.concatenate([[0], np.cumsum(w.data == 10)])
        line_end = np.ones(n, dtype=bool)  # a text's last word is followed by a line feed too
        line_end[:-1] = newlines[w.start[1:]] != newlines[w.end[:-1]]
        sentence_end = line_end | _ENDS[w.data[w.end - 1]]
        first = np.flatnonzero(np.concatenate([[True], sentence_end[:-1]])) if n else np.zeros(0, dtype=np.int64)
        size = np.diff(np.concatenate([first, [n]]))
        pair = mix64(w.hash[:-1] * np.uint64(_PAIR) + w.hash[1:])
        chosen = np.zeros(n, dtype=bool)
        chosen[1:] = pair % np.uint64(CUT_EVERY) == 0
        chosen[first] = False  # a pair within one sentence only: no cut depends on the text before it
        sentence_end |= chosen & np.repeat(size > LONG_SENTENCE, size)
        self.first = np.flatnonzero(np.concatenate([[True], sentence_end[:-1]])) if n else first
        self.size = np.diff(np.concatenate([self.first, [n]]))
        self.text = w.text[self.first]
        self.number = np.arange(len(self.first)) - np.searchsorted(self.text, self.text)  # within its text
        # hash of the words in order
        powers, inverse = np.full(n + 1, _MULT, dtype=np.uint64), np.full(n + 1, _MULT_INVERSE, dtype=np.uint64)
        powers[0] = inverse[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(inverse, out=inverse)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(w.hash * powers[:n], out=sums[1:])
        self._sums, self._inverse = sums, inverse
        total = (sums[self.first + self.size] - sums[self.first]) * inverse[self.first]
        self.hash = mix64(total + self.size.astype(np.uint64))
        # lines: ranges of words
        self.line_first = np.flatnonzero(np.concatenate([[True], line_end[:-1]])) if n else first
        self.line_size = np.diff(np.concatenate([self.line_first, [n]]))
        self.line_text = w.text[self.line_first]
        self.line_number = np.arange(len(self.line_first)) - np.searchsorted(self.line_text, self.line_text)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the seeds, ascending.

        Windows of ``SEED`` words that begin in two texts are at least ``SEED``
        places apart, so ``SEED`` neighbouring places never mix two texts.
        """
        w, count = self.words, len(self.words.start) - SEED + 1
        if count < SEED:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        value = ~mix64((self._sums[SEED:] - self._sums[:count]) * self._inverse[:count] + np.uint64(SEED))
        whole = w.text[:count] == w.text[SEED - 1:]
        least = sliding(np.minimum, value)
        least[~(whole[:len(least)] & whole[SEED - 1:])] = 0  # places beside a text's end are no windows
        pad = np.zeros(SEED - 1, dtype=np.uint64)
        chosen = np.flatnonzero(whole & (value == sliding(np.maximum, np.concatenate([pad, least, pad]))))
        return chosen, value[chosen]


def sliding(pick: np.ufunc, values: np.ndarray) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``SEED`` neighbouring values."""
    out, width = values.copy(), 1
    while width < SEED:
        step = min(width, SEED - width)
        out = pick(out[:-step], out[step:])
        width += step
    return out


def _repeat_rows(plan: PassagePlan):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, encoded in groups(batch.column("text")):
                s = Sentences(encoded)
                some = np.flatnonzero(s.size >= plan.min_sentence_words)
                seed, value = s.seeds()
                of = s.words.text[seed]
                h = np.concatenate([s.hash[some], value]).view(np.int64)
                doc = ids.take(pa.array(begin + np.concatenate([s.text[some], of])))
                later = _later(h, doc.to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), doc,
                     pa.array(np.concatenate([s.number[some], -1 - (seed - s.words.first[of])]).astype(np.int32)),
                     pa.array(np.where(later, 1 + doc.to_numpy() % SALTS, 0).astype(np.int32))],
                    ["h", "doc_id", "place", "known"])

    return rows


def _later(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows have a row with an equal ``h`` and a smaller ``doc`` beside them."""
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0])) if len(h) else order
    least = np.minimum.reduceat(doc[order], first) if len(h) else doc
    later = np.empty(len(h), dtype=bool)
    later[order] = doc[order] > np.repeat(least, np.diff(np.concatenate([first, [len(h)]])))
    return later


def _line_rows(plan: PassagePlan):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, encoded in groups(batch.column("text")):
                s = Sentences(encoded)
                w = s.words
                some = np.flatnonzero(s.line_size >= plan.min_line_words)
                last = s.line_first[some] + s.line_size[some] - 1
                texts = [w.data[a:b].tobytes().decode("utf-8") for a, b in zip(w.start[s.line_first[some]], w.end[last])]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(begin + s.line_text[some])), pa.array(s.line_number[some].astype(np.int32)),
                     pa.array(texts, pa.string())], ["doc_id", "place", "text"])

    return rows


def repeated_parts(docs: DataFrame, plan: PassagePlan = PassagePlan()) -> DataFrame:
    """``doc_id, place`` of sentences and seeds that a smaller doc_id has too (``docs``: doc_id, text).

    A place from 0 is a sentence's number, a place below 0 the word -1 - place
    at which a seed begins; rows that repeat a doc_id repeat its places.  Of the
    equal parts of one group of texts only those of its smallest doc_id have to
    meet the other groups' (``known`` is 0); the others are repeated for certain
    and dealt apart, so a part that is everywhere does not meet in one task.
    """
    rows = docs.filter("doc_id is not null").mapInArrow(_repeat_rows(plan), "h long, doc_id long, place int, known int")
    first = F.min("doc_id").over(Window.partitionBy("h", "known"))
    return rows.withColumn("_first", first).filter("known > 0 or doc_id > _first").select("doc_id", "place")


def repeated_lines(spark: SparkSession, docs: DataFrame, plan: PassagePlan = PassagePlan()) -> DataFrame:
    """``doc_id, place`` of long lines that are not the first of their component (``docs``: doc_id, text)."""
    lines = docs.filter("doc_id is not null").mapInArrow(_line_rows(plan), "doc_id long, place int, text string")
    # written once: the texts are cut in one pass, and later joins do not run beside Python workers
    lines = materialise(spark, lines.withColumn("line", F.xxhash64("doc_id", "place", "text")), "line-texts")
    found = near_duplicates(spark, lines, "line", "text", plan.bands).select(F.col("doc_id").alias("line"), "component_id")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    members = materialise(spark, found.join(several, "component_id"), "lines")
    placed = lines.select("doc_id", "place", "line").join(members, "line")
    placed = materialise(spark, placed.select("doc_id", "place", "component_id"), "lines")
    first = placed.groupBy("component_id").agg(F.min("doc_id").alias("_first"))
    return placed.join(first, "component_id").filter("doc_id > _first").select("doc_id", "place").distinct()


def removed_spans(s: Sentences, i: int, parts: set[int], lines: set[int], plan: PassagePlan) -> list[tuple[int, int]]:
    """Byte spans to remove from text ``i`` of a group, ascending and apart (``parts``: see ``repeated_parts``)."""
    w = s.words
    base, n = int(w.first[i]), int(w.first[i + 1] - w.first[i])
    marked, repeated = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    lo, hi = np.searchsorted(s.line_text, [i, i + 1])
    for k in range(lo, hi):
        if k - lo in lines:
            marked[s.line_first[k] - base:s.line_first[k] - base + s.line_size[k]] = True
    lo, hi = np.searchsorted(s.text, [i, i + 1])
    k = lo
    while k < hi:
        if k - lo not in parts:
            k += 1
            continue
        begin, end = k, k + 1  # the run is [begin, end)
        while k < hi and (k - lo in parts or s.size[k] < plan.min_sentence_words):
            k += 1
            end = k if k - 1 - lo in parts else end
        repeated[s.first[begin] - base:s.first[end - 1] + s.size[end - 1] - base] = True
    for place in parts:
        if place < 0:
            repeated[-1 - place:-1 - place + SEED] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    for a, b in zip(edge[::2], edge[1::2]):
        if b - a >= plan.min_run_words:
            marked[a:b] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return [(int(w.start[base + a] - w.text_start[i]), int(w.end[base + b - 1] - w.text_start[i]))
            for a, b in zip(edge[::2], edge[1::2])]


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the spans; of the white space on both sides of one, the longer break stays."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
        if out[-1].endswith(b"\n") or (not out[-1] and len(out) == 1):
            while at < len(text) and text[at:at + 1] in b" \n":
                at += 1
        elif out[-1].endswith(b" ") and text[at:at + 1] in (b" ", b"\n"):
            out[-1] = out[-1][:-1]
    out.append(text[at:])
    return b"".join(out)


def _cleaner(names: list[str], text: str, plan: PassagePlan):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, encoded in groups(batch.column(text)):
                yield cleaned(batch.slice(begin, len(encoded)), encoded)

    def cleaned(part: pa.RecordBatch, encoded: list[bytes]) -> pa.RecordBatch:
        """One group of texts, so that no more than these are held in two versions."""
        column, repeats, lines = (part.column(c) for c in (text, "_parts", "_lines"))
        at = {i for i in range(len(encoded)) if repeats[i].is_valid or lines[i].is_valid}
        s = Sentences(encoded) if at else None
        texts, counts, spans = [], [], []
        for i, raw in enumerate(encoded):
            found = removed_spans(s, i, set(repeats[i].as_py() or ()), set(lines[i].as_py() or ()), plan) if i in at else []
            new = without_spans(raw, found) if found else raw
            texts.append(new.decode("utf-8") if column[i].is_valid else None)
            spans.append(len(found))
            counts.append(sum(len(raw[a:b].split()) for a, b in found))
        arrays = [pa.array(texts, pa.string()) if c == text else part.column(c) for c in names]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(spans, pa.int64()), pa.array(counts, pa.int64())], [*names, "_spans", "_removed"])

    return rows


def _cleaned(spark: SparkSession, docs: DataFrame, plan: PassagePlan, doc_id: str, text: str) -> DataFrame:
    """The columns of ``docs`` in order under other names, and ``_spans, _removed``."""
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])  # free of clashes with the columns made here
    key, body = f"_c{names.index(doc_id)}", f"_c{names.index(text)}"
    pairs = plain.select(F.col(key).cast("long").alias("doc_id"), F.col(body).alias("text"))
    lines = repeated_lines(spark, pairs, plan).withColumn("line", F.lit(True))
    marks = repeated_parts(pairs, plan).withColumn("line", F.lit(False)).unionAll(lines)
    # at most the sentences, seeds and lines of one document are gathered
    marks = materialise(spark, marks.groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("line"), F.col("place"))).alias("_parts"),
        F.collect_set(F.when(F.col("line"), F.col("place"))).alias("_lines")).withColumnRenamed("doc_id", "_id"), "marks")
    joined = plain.join(marks, plain[key].cast("long") == marks["_id"], "left").drop("_id")
    schema = StructType([StructField(f.name, StringType() if f.name == body else f.dataType) for f in plain.schema]
                        + [StructField("_spans", LongType()), StructField("_removed", LongType())])
    cleaned = joined.mapInArrow(_cleaner(plain.columns, body, plan), schema)
    if "n_chars" in names:
        n = f"_c{names.index('n_chars')}"
        cleaned = cleaned.withColumn(n, F.when(F.col("_spans") > 0, F.length(body)).otherwise(F.col(n))
                                     .cast(plain.schema[n].dataType))
    return cleaned


def clean_passages(spark: SparkSession, docs: DataFrame, plan: PassagePlan = PassagePlan(), doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``docs`` with repeated passages removed from its texts, and ``_spans, _removed`` (spans and words removed)."""
    return _cleaned(spark, docs, plan, doc_id, text).toDF(*docs.columns, "_spans", "_removed")


def dedup_passages(spark: SparkSession, docs: DataFrame, plan: PassagePlan = PassagePlan(), doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``docs`` with repeated passages removed from its texts; see the module's text."""
    return _cleaned(spark, docs, plan, doc_id, text).drop("_spans", "_removed").toDF(*docs.columns)
