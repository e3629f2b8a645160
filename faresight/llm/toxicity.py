"""Toxicity: gradient-boosted trees over dense text features, isotonically calibrated.

Learning (from labelled documents only):

1. A sample of at most ``max_sample`` labelled documents that are not held out
   (crc32 of the doc_id's text modulo 5 is not 0) is taken by hash and written
   once.  This bound is the only one; every document is scored.
2. A lexicon of words and of 6-letter word beginnings that are significantly
   more frequent in toxic documents is learned from document counts (one
   distributed aggregation).  Counts are kept for each of four folds: a
   training document's features use a lexicon learned without its own fold,
   so the trees see lexicon hits as they will be on new texts.
3. Spark ML's gradient-boosted trees are fitted on three folds; isotonic
   regression maps their margin to a probability on the fourth.

Scoring is one pass over the whole texts.  Labels, language, source and
doc_id are never inputs of a score; the lexicon travels with the tasks and has
at most ``lexicon_size`` terms.

Cases: a null or empty text has all-zero features and is scored like any
other; a null doc_id counts as the text '' for the hold-out rule and has no
label; repeated rows are scored alike; a doc_id labelled more than once is
toxic if any of its labels is 1, and null labels are left out; with no labelled
rows, or labels of one class only, every score is the smoothed share of 1s;
an empty table gives no rows; extra columns are ignored by ``toxicity_scores``
and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from faresight.llm.tables import materialise

HOLD_OUT = 5
FOLDS = 4
STEM = 6
NEAR = 5  # words
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu toi te ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros os vuestro".split())

_WORD = re.compile(r"[^\W\d_]+")
# A token of letters with digits or signs between them, such as "st*pid" or "1d.i0t".
_DISGUISED = re.compile(r"(?<!\S)(?=\S*[^\W\d_])[\w@$*.\-!|]*[^\W\d_][\d@$*.\-!|]+[^\W\d_][\w@$*.\-!|]*")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                       "|": "i", "*": None, ".": None, "-": None, "_": None})
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_SHOUTED = re.compile(r"\b[^\W\d_a-z]{3,}\b")
_MARKS = re.compile(r"[!?]{2,}")


@dataclass(frozen=True)
class ToxicityModel:
    """Bounds and sizes of the fit."""

    max_sample: int = 20_000
    lexicon_size: int = 300
    min_documents: int = 3
    min_z: float = 3.0
    trees: int = 20
    depth: int = 4


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % HOLD_OUT == 0


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Dense features of one text.  ``lexicon``: weights of words, and of beginnings written ``^abcdef``."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = len(words)
    if not n:
        return [0.0] * 14
    hits = [(i, max(lexicon.get(w, 0.0), lexicon.get("^" + w[:STEM], 0.0)))
            for i, w in enumerate(words) if w in lexicon or "^" + w[:STEM] in lexicon]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    persons = set()
    for i in second if hits else ():
        persons.update(range(i - NEAR, i + NEAR + 1))
    near = sum(i in persons for i, _ in hits)
    disguised = [m.lower().translate(_LEET) for m in _DISGUISED.findall(text)]
    hidden = sum(1 for m in disguised if m in lexicon)
    chars = len(text)
    weights = [w for _, w in hits]
    upper = sum(map(str.isupper, text))
    return [
        len(hits) / n, sum(weights) / n, math.log1p(len(hits)), max(weights, default=0.0), math.log1p(sum(weights)),
        len({words[i] for i, _ in hits}) * 1.0, near / n, len(second) / n, upper / chars,
        len(_SHOUTED.findall(text)) / n, (text.count("!") + text.count("?")) / chars, len(_MARKS.findall(text)) / n,
        (len(disguised) - hidden) / n + len(_STRETCHED.findall(text)) / n, math.log1p(hidden),
    ]


def _featured(docs: DataFrame, text: str, keep: list[str], lexicon_of: Callable[[pa.RecordBatch], list[dict]]) -> DataFrame:
    """``keep`` columns and ``features`` (array) of every row."""
    schema = StructType(docs.select(*keep).schema.fields + [StructField("features", ArrayType(DoubleType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t.as_py(), lex) for t, lex in zip(batch.column(text), lexicon_of(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(made, pa.list_(pa.float64()))], [*keep, "features"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(rows, schema)


def learn_lexicons(sample: DataFrame, model: ToxicityModel) -> list[dict[str, float]]:
    """Lexicons learned without fold 0, 1, ...; the last one from all folds.

    ``sample``: doc_id, text, toxic, fold (at most ``max_sample`` rows).  Only
    terms that pass the tests and the size bound come to the driver.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}]+"), F.lit(0)))
    terms = F.array_union(words, F.array_distinct(F.transform(
        F.filter(words, lambda w: F.length(w) >= STEM), lambda w: F.concat(F.lit("^"), F.substring(w, 1, STEM)))))
    counts = sample.select("fold", "toxic", F.explode(terms).alias("term")).groupBy("term").agg(
        *[F.sum((F.col("toxic") == y).cast("int") * (F.col("fold") == k).cast("int")).alias(f"d{y}_{k}")
          for y in (0, 1) for k in range(FOLDS)])
    totals = {(r["toxic"], r["fold"]): r["count"] for r in sample.groupBy("toxic", "fold").count().collect()}
    out = []
    for left_out in [*range(FOLDS), None]:
        folds = [k for k in range(FOLDS) if k != left_out]
        pos, neg = (sum(totals.get((y, k), 0) for k in folds) for y in (1, 0))
        d1, d0 = (sum((F.col(f"d{y}_{k}") for k in folds), F.lit(0)) for y in (1, 0))
        odds = F.log((d1 + 0.5) / (pos + 1)) - F.log((d0 + 0.5) / (neg + 1))
        z = odds / F.sqrt(1 / (d1 + 0.5) + 1 / (d0 + 0.5))
        top = (counts.filter(d1 >= model.min_documents).select("term", odds.alias("odds"), z.alias("z"))
               .filter(F.col("z") >= model.min_z).orderBy(F.desc("z"), "term").limit(model.lexicon_size))
        out.append({r["term"]: float(r["odds"]) for r in top.collect()})
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, model: ToxicityModel, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """At most ``max_sample`` labelled documents that are not held out: doc_id, text, toxic, fold."""
    wanted = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(model.max_sample))
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(wanted), F.col("doc_id") == F.col("_id")).select(  # bounded: max_sample rows of two numbers
        "doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold"))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, model: ToxicityModel = ToxicityModel(),
        doc_id: str = "doc_id", text: str = "text") -> Callable[[DataFrame, str, list[str]], DataFrame]:
    """A function ``(docs, text, keep) -> keep columns and score``."""
    sample = materialise(spark, labelled_sample(docs, labels, model, doc_id, text), "toxicity-sample")
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, n):
        prior = (toxic + 0.5) / (n + 1)
        return lambda d, t, keep: d.select(*keep, F.lit(prior).alias("score"))
    lexicons = learn_lexicons(sample, model)
    final = lexicons[-1]
    data = _featured(sample, "text", ["toxic", "fold"], lambda batch: [lexicons[k.as_py()] for k in batch.column("fold")])
    data = materialise(spark, data, "toxicity-features").select(
        F.col("toxic").cast("double").alias("label"), "fold", array_to_vector("features").alias("features")).coalesce(4)
    trees = GBTClassifier(maxIter=model.trees, maxDepth=model.depth, stepSize=0.2, seed=5, maxMemoryInMB=64)
    fitted = trees.fit(data.filter(F.col("fold") < FOLDS - 1))
    margin = vector_to_array("rawPrediction")[1].alias("margin")
    calibrated = IsotonicRegression(featuresCol="margin", predictionCol="score").fit(
        fitted.transform(data.filter(F.col("fold") == FOLDS - 1)).select("label", margin))

    def score(d: DataFrame, t: str, keep: list[str]) -> DataFrame:
        made = _featured(d, t, keep, lambda batch: [final] * batch.num_rows).withColumn("features", array_to_vector("features"))
        return calibrated.transform(fitted.transform(made).select(*keep, margin)).select(
            *keep, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))

    return score


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame,
                    model: ToxicityModel = ToxicityModel(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; see the module's text."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = fit(spark, docs, labels, model)(docs, "text", ["doc_id"])
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, model: ToxicityModel = ToxicityModel(),
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without documents scored 0.5 or more; all columns are kept."""
    names = docs.columns
    score = fit(spark, docs, labels, model, doc_id, text)
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])  # free of clashes with the columns made here
    return score(plain, f"_c{names.index(text)}", plain.columns).filter(F.col("score") < 0.5).drop("score").toDF(*names)
