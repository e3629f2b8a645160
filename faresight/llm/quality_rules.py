"""Quality rules: per-text statistics and cross-document line frequency (native).

Only DataFrame functions run here; there is no Python code in the tasks.

1. Base statistics come from the words and lines of the whole text.  Repeated
   8-word windows are found by hashing: a window's hash is built from two
   4-word hashes, those from 2-word hashes.  Only a text whose window hashes
   are not all distinct sorts them to find the covered words.
2. Line frequency: each distinct normalised line (words joined by one blank,
   A-Z lower-cased) of a text is hashed; for each host the distinct texts that
   hold it are counted.  Exact copies of a text are one document here, so a
   page that was merely crawled many times does not lose its lines.
3. A line of at most ``max_line_words`` words found in more than
   ``max_documents`` distinct documents of one host is boilerplate and is
   removed.  (Longer repeated lines are passages; duplicate removal keeps one
   copy of those, this rule would keep none.)
4. A document is rejected if its base rules fail, or if removed lines leave
   fewer than ``min_left_words`` words or less than ``min_left_share`` of its
   words.

Counting pre-aggregates per task; a frequent line reaches its reducer as at
most one row for each task, and the join that marks a frequent line's
documents is a plain sort-merge join whose hot key AQE can split.

Cases: a null text is an empty one (no words; base rules fail); a null host is
the host ``''``; null or repeated doc_ids and repeated rows each give their own
row with the same figures; an empty table gives no rows; columns other than
the named ones are ignored by ``quality_verdicts`` and kept by
``apply_quality_rules``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8


@dataclass(frozen=True)
class QualityLimits:
    """Limits of the rules; see the module's text."""

    max_documents: int = 20
    max_line_words: int = 20
    min_words: int = 20
    max_repeat_percent: int = 30
    min_left_words: int = 8
    min_left_share: float = 0.4


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def _neighbours(a: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on."""
    both = F.zip_with(a, F.slice(a, F.lit(step + 1), F.size(a)), lambda x, y: F.xxhash64(x, y))
    return F.slice(both, F.lit(1), F.size(a) - step)


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])),
            lambda x: x["i"]))

    def words(p: Column) -> Column:
        new = F.transform(p, lambda x, i: F.least(F.coalesce(x - F.get(p, i - 1), F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(_let(pairs, repeated), words)


def _repeat_words(words: Column) -> Column:
    """Number of words lying in an 8-word window that the text holds twice."""
    def found(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w))

    def some(h: Column) -> Column:
        eight = _let(_let(_let(h, lambda a: _neighbours(a, 1)), lambda a: _neighbours(a, 2)),
                     lambda a: _neighbours(a, 4))
        return F.when(F.size(h) < WINDOW, F.lit(0).cast("long")).otherwise(_let(eight, found))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), some)


def _removed_characters(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _parsed(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("_text", t).withColumn(
        "_line_words", F.transform(F.split("_text", "\n", -1), lambda l: F.regexp_extract_all(l, F.lit(WORD), F.lit(0))))


def _line_facts() -> Column:
    """(hash of the normalised line, words) of every line with a word."""
    return F.transform(
        F.filter("_line_words", lambda w: F.size(w) > 0),
        lambda w: F.struct(F.xxhash64(F.translate(F.array_join(w, " "), UPPER, UPPER.lower())).alias("h"),
                           F.size(w).alias("n")))


def line_occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row for each distinct normalised line of each document:
    ``_doc, _digest, _host, line, line_words``."""
    facts = _parsed(docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(host), F.lit("")).alias("_host"),
                                F.col(text).alias("_t")), "_t")
    return facts.select("_doc", F.xxhash64("_text").alias("_digest"), "_host",
                        F.explode(F.array_distinct(_line_facts())).alias("_l")).select(
        "_doc", "_digest", "_host", F.col("_l.h").alias("line"), F.col("_l.n").alias("line_words"))


def frequent_lines(lines: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Boilerplate: ``_host, line`` found in too many distinct documents of a host."""
    short = lines.filter(F.col("line_words") <= limits.max_line_words)
    return (short.select("_host", "line", "_digest").distinct()
            .groupBy("_host", "line").count()
            .filter(F.col("count") > limits.max_documents).select("_host", "line"))


def _boilerplate_by_document(docs: DataFrame, limits: QualityLimits, doc_id: str, text: str, host: str) -> DataFrame:
    """Documents that hold boilerplate: ``_doc, _digest, _bad`` (their line hashes)."""
    lines = line_occurrences(docs, doc_id, text, host)
    return (lines.filter(F.col("line_words") <= limits.max_line_words)
            .join(frequent_lines(lines, limits), ["_host", "line"])
            .groupBy("_doc", "_digest", "_host").agg(F.collect_set("line").alias("_bad")))


def quality_verdicts(docs: DataFrame, limits: QualityLimits = QualityLimits(), doc_id: str = "doc_id",
                     text: str = "text", host: str = "source") -> DataFrame:
    """Statistics and verdict of every document; see the module's text.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_removed_lines, n_left_words, kept.
    """
    parsed = _parsed(docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(host), F.lit("")).alias("_host"),
                                 F.col(text).alias("_t")), "_t")
    worded = F.filter(F.split("_text", "\n", -1), lambda l: F.length(F.translate(l, SPACES, "")) > 0)
    stats = parsed.select(
        "_doc", "_host", F.xxhash64("_text").alias("_digest"),
        _let(F.flatten("_line_words"), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"))).alias("_w"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        _removed_characters(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        _let(worded, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        _line_facts().alias("_lines"))
    bad = _boilerplate_by_document(docs, limits, doc_id, text, host).select(
        F.col("_doc").alias("_d"), F.col("_digest").alias("_g"), F.col("_host").alias("_h"), "_bad")
    joined = stats.join(bad, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_digest") == F.col("_g"))
                        & (F.col("_host") == F.col("_h")), "left")
    left = F.filter("_lines", lambda l: ~F.array_contains(F.col("_bad"), l["h"]))
    left_words = F.aggregate(left, F.lit(0).cast("long"), lambda a, l: a + l["n"])
    n, rep = F.col("_w.n_words"), F.col("_w.n_repeat_words")
    out = joined.select(
        F.col("_doc").alias("doc_id"), n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        rep.alias("n_repeat_words"),
        ((n < limits.min_words) | (100 * rep > limits.max_repeat_percent * n)).alias("base_failed"),
        F.when(F.col("_bad").isNull(), F.lit(0)).otherwise(F.size("_lines") - F.size(left)).cast("long")
        .alias("n_removed_lines"),
        F.when(F.col("_bad").isNull(), n).otherwise(left_words).alias("n_left_words"))
    depleted = (F.col("n_left_words") < limits.min_left_words) | (F.col("n_left_words") < limits.min_left_share * F.col("n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def apply_quality_rules(docs: DataFrame, limits: QualityLimits = QualityLimits(), doc_id: str = "doc_id",
                        text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` without rejected documents and, in the others, without boilerplate lines.

    All columns are kept.  The text of a document without boilerplate is
    returned as it is, so the join carries a text only to its own row.
    """
    names = docs.columns
    bad = _boilerplate_by_document(docs, limits, doc_id, text, host).select(
        F.col("_doc").alias("_d"), F.col("_digest").alias("_g"), F.col("_host").alias("_h"), "_bad")
    keyed = (docs.withColumn("_digest", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
             .withColumn("_host", F.coalesce(F.col(host), F.lit(""))))
    # Base rules are checked before the join: rejected texts are not shuffled.
    parsed = _parsed(keyed, text).withColumn(
        "_w", _let(F.flatten("_line_words"), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), _repeat_words(w).alias("rep"))))
    sound = parsed.filter((F.col("_w.n") >= limits.min_words)
                          & (100 * F.col("_w.rep") <= limits.max_repeat_percent * F.col("_w.n"))) \
        .select(*[F.col(f"`{c}`") for c in names], "_digest", "_host", F.col("_w.n").alias("_n"))
    joined = sound.join(bad, F.col(doc_id).eqNullSafe(F.col("_d")) & (F.col("_digest") == F.col("_g"))
                        & (F.col("_host") == F.col("_h")), "left")
    line = F.transform(F.split(F.col(text), "\n", -1), lambda l: F.struct(
        l.alias("l"), F.regexp_extract_all(l, F.lit(WORD), F.lit(0)).alias("w")))
    good = F.filter(line, lambda x: (F.size(x["w"]) == 0) | ~F.array_contains(
        F.col("_bad"), F.xxhash64(F.translate(F.array_join(x["w"], " "), UPPER, UPPER.lower()))))
    cleaned = joined.withColumn("_left", F.when(F.col("_bad").isNotNull(), good)) \
        .withColumn("_left_n", F.when(F.col("_bad").isNull(), F.col("_n")).otherwise(
            F.aggregate("_left", F.lit(0).cast("long"), lambda a, x: a + F.size(x["w"]))))
    kept = cleaned.filter((F.col("_left_n") >= limits.min_left_words)
                          & (F.col("_left_n") >= limits.min_left_share * F.col("_n")))
    new_text = F.when(F.col("_bad").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform("_left", lambda x: x["l"]), "\n"))
    changed = [new_text.alias(c) if c == text else F.col(f"`{c}`") for c in names]
    if "n_chars" in names:
        changed = [F.when(F.col("_bad").isNull(), F.col("n_chars")).otherwise(F.length(new_text))
                   .cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else x
                   for c, x in zip(names, changed)]
    return kept.select(*changed)
