"""Spelling variants of a corpus's words, found with permuterm rotations.

Words are counted over whole texts (each task adds up its own counts first),
sorted and numbered in code-point order; from then on a word is a number.  Two
words are near if one code point is inserted, deleted or replaced.

A word ``w`` marked with a terminator, ``w$``, has one rotation for each of its
places.  For the code point ``x`` at some place, ``w = a x b``, the rotation
that ends with it is ``b$a x``: words that differ there alone, ``a y b``, and the
word without it, ``a b`` (whose rotation ``b$a`` is the prefix itself), stand in
the range of the prefix ``b$a``.  So every rotation is listed under its prefix
without the edited code point and, as a shorter word's, under its whole; the
list is sorted, and each range is scanned once.  A range holds at most one word
for each letter and one whole rotation, whatever the data.  From it every
member gets one row with its number of neighbours there and the best of them;
no pair is written.  An inserted code point equal to its successor is counted
at the last place of the run only, so no pair counts twice.

A word's form is its near word with the largest count if that is at least
``ratio`` times its own (ties: the first in code-point order); counts grow along
forms, so following them ends, and doubling the step finds the last one.

Rotations of over ``TEXT_KEY`` code points are listed by two rolling hashes
modulo the prime 2**61 - 1 (122 bits) instead of their text, so a word of any
length costs time and space in proportion to it.

Cases: a null or empty text has no words; a null doc_id is the empty text in
the misspelling rule; repeated rows count each time; an empty table gives no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.tables import materialise

LETTERS = "A-Za-zÀ-ÿ"
END = "$"
TEXT_KEY = 64            # longer rotations are listed by hash
FLUSH = 1 << 18          # words that a task holds before it hands on its counts
PRIME = (1 << 61) - 1
BASES = (0x1F3A5C7E9B2D4861 % PRIME, 0x0D6E8A1C4F72B935 % PRIME)

Misspell = Callable[[str, str], str]


@dataclass(frozen=True)
class SpellingPlan:
    min_length: int = 7      # code points of a word
    min_count: int = 2       # occurrences of a word
    ratio: int = 10          # how much more frequent a form is than the word


def drop_letter(every: int) -> Misspell:
    """Where ``every`` divides the CRC-32 h of ``doc_id:run``, the run loses its code point ``h % length``."""
    def misspell(doc_id: str, run: str) -> str:
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]
    return misspell


# -- words ------------------------------------------------------------------------

def word_counts(docs: DataFrame, plan: SpellingPlan = SpellingPlan(), misspell: Misspell | None = None,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the runs of letters, A-Z lower-cased, that are long and frequent enough."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]{{{plan.min_length},}}")
        total: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                name = name.as_py() or ""
                # bytes.lower changes A-Z only
                own = Counter(runs.findall(body.as_py().lower().decode("utf-8")))
                if misspell is None:
                    total.update(own)
                    continue
                for run, n in own.items():
                    word = misspell(name, run)
                    if len(word) >= plan.min_length:
                        total[word] += n
                if len(total) > FLUSH:
                    yield handed_on()
            if len(total) > FLUSH:
                yield handed_on()
        yield handed_on()

    texts = docs.select(F.col(doc_id).cast("string").alias("_id"), F.col(text).alias("_text")).filter("_text is not null")
    return (texts.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                 .filter(F.col("n") >= plan.min_count))


# -- rotations --------------------------------------------------------------------

def rotation_keys(word: str) -> Iterator[tuple[str, str, bool]]:
    """``(key, letter, repeated)`` of every listing of a word.

    A skipping key is a rotation without its last code point, ``letter``, which
    is ``repeated`` if the next one in the word equals it; a whole rotation has
    an empty letter.
    """
    marked = word + END
    m = len(marked)
    if m <= TEXT_KEY:
        twice = marked + marked
        for i in range(m):
            yield twice[i:i + m], "", False
    else:
        yield from ((key, "", False) for key in _hashed_keys(marked, m))
    if m - 1 <= TEXT_KEY:
        twice = marked + marked
        for i, letter in enumerate(word):
            yield twice[i + 1:i + m], letter, marked[i + 1] == letter
    else:
        keys = _hashed_keys(marked, m - 1)
        next(keys)      # the rotation that starts at place 0 lacks the terminator
        # a rotation from place i + 1 that lacks its last code point lacks the one at place i
        yield from ((key, letter, marked[i + 1] == letter) for i, (letter, key) in enumerate(zip(word, keys)))


def _hashed_keys(marked: str, size: int) -> Iterator[str]:
    """Rolling hashes of the first ``size`` code points of every rotation, from place 0 on."""
    codes = [ord(c) for c in marked]
    m, states = len(codes), []
    for base in BASES:
        h = 0
        for c in codes[:size]:
            h = (h * base + c) % PRIME
        states.append([h, base, pow(base, size - 1, PRIME)])
    for i in range(m):
        yield f"\x01{size}:{states[0][0]:016x}{states[1][0]:016x}"
        out, into = codes[i], codes[(i + size) % m]
        for s in states:
            s[0] = ((s[0] - out * s[2]) * s[1] + into) % PRIME


def _rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, n, word`` -> listings, in batches of bounded size."""
    for batch in batches:
        keys, letters, repeated, ids, counts = [], [], [], [], []

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(letters, pa.string()), pa.array(repeated, pa.bool_()),
                 pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], ["key", "letter", "repeated", "id", "n"])

        for i, n, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            for key, letter, again in rotation_keys(word.as_py()):
                keys.append(key)
                letters.append(letter)
                repeated.append(again)
                ids.append(i)
                counts.append(n)
                if len(keys) >= 50_000:
                    yield listed()
                    keys, letters, repeated, ids, counts = [], [], [], [], []
        yield listed()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted listings -> for each member of a range its neighbours there: ``id, near, best_n, best``."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if held is not None:
            now = pa.concat_tables([held, now]).combine_chunks()
        if not now.num_rows:
            continue
        keys = now.column("key").combine_chunks()
        change = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        begin = np.concatenate([[0], np.flatnonzero(change) + 1])
        held = now.slice(begin[-1])     # the last range may go on in the next batch
        yield _neighbours(now, begin)
    if held is not None:
        yield _neighbours(held, np.array([0, held.num_rows]))


def _neighbours(rows: pa.Table, begin: np.ndarray) -> pa.RecordBatch:
    ranges = [(a, b) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()) if b - a > 1]
    where = np.concatenate([np.arange(a, b) for a, b in ranges]) if ranges else np.zeros(0, np.int64)
    taken = rows.select(["letter", "repeated", "id", "n"]).take(pa.array(where)).to_pydict()
    members = list(zip(taken["n"], taken["id"], taken["letter"], taken["repeated"]))
    out, at = [], 0
    for a, b in ranges:
        own = sorted(members[at:at + b - a], key=lambda m: (-m[0], m[1]))
        at += b - a
        skipping = [m for m in own if m[2]]
        inserted = [m for m in skipping if not m[3]]
        for m in own:
            # a whole rotation meets the insertions, a skipping one the other letters and, unless repeated, the whole one
            met = inserted if not m[2] else skipping if m[3] else own
            near = len(met) - (m[2] != "")
            if near:
                best = met[0] if met[0] is not m else met[1]
                out.append((m[1], near, best[0], best[1]))
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "near", "best_n", "best"])


# -- forms ------------------------------------------------------------------------

def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``id, root`` of the words that have a form (``id, form``), by steps of doubled length."""
    at = materialise(spark, forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        if at.join(further, "root", "left_semi").isEmpty():
            return at
        at = materialise(spark, at.join(further, "root", "left").select(
            "id", F.coalesce("_next", "root").alias("root")), "spelling-roots")


def spelling_variants(spark: SparkSession, docs: DataFrame, plan: SpellingPlan = SpellingPlan(),
                      misspell: Misspell | None = None) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    counted = word_counts(docs, plan, misspell)
    words = materialise(spark, counted.repartitionByRange("word").sortWithinPartitions("word").withColumn(
        "id", F.monotonically_increasing_id()), "spelling-words")
    listed = words.select("id", "n", "word").mapInArrow(
        _rotate, "key string, letter string, repeated boolean, id long, n long")
    ranges = listed.repartitionByRange("key").sortWithinPartitions("key")
    found = materialise(spark, ranges.mapInArrow(_scan, "id long, near long, best_n long, best long"), "spelling-near")
    # the smallest number is the first word in code-point order
    best = F.max(F.struct("best_n", -F.col("best")))
    links = found.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("b"))
    linked = materialise(spark, words.select("id", "n").join(links, "id").select(
        "id", "n_near", F.when(F.col("b.best_n") >= plan.ratio * F.col("n"), -F.col("b.col2")).alias("form")), "spelling-links")
    roots = _roots(spark, linked.filter("form is not null").select("id", "form"))
    named = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    last = words.select(F.col("id").alias("root_id"), F.col("word").alias("root_word"))
    forms = (linked.filter("form is not null").select("id", "form").join(roots.withColumnRenamed("root", "root_id"), "id")
                   .join(named, "form").join(last, "root_id").select("id", "form_word", "form_n", "root_word"))
    return (words.join(linked.select("id", "n_near"), "id", "left").join(forms, "id", "left")
                 .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                         F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
