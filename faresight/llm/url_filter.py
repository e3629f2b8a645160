"""URL filters through Bloom filter cascades.

Every key that a rule or list could match in the corpus (its complete key
universe) is known, so membership can be encoded exactly: level 1 is a Bloom
filter of the listed keys, level 2 one of the unlisted keys that pass level 1,
level 3 one of the listed keys that pass level 2, and so on until no key
passes wrongly.  A key is listed if the first level that rejects it has an even
number, or if none does and the number of levels is odd.

Keys are 128-bit hashes, dealt to shards by hash; a shard's distinct keys (about
``SHARD_KEYS``) are built into a cascade by one task.  URLs are judged without
a join against the lists: the cascades (some bits for each listed key) are
broadcast if they are smaller than ``broadcast_bytes``; above that, keys and
cascades meet by shard, with salt, so that neither side is gathered.

Two lists go into the cascades, under different key prefixes:

* the host and path rules.  Each URL's candidates are its host and parent
  domains, each with the beginnings of its path as long as some rule's path;
  the longest candidate that is listed wins, its verdict being the rule's;
* addresses (host and path) that ``repeated_addresses`` finds on
  ``min_pages`` pages or more with different URLs, such as session and
  tracking variants.  URLs without a rule are blocked if listed, else allowed.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is allowed; the first ``://`` counts; repeated rows are judged alike;
null page_ids are kept; an empty table gives no rows; empty lists list
nothing; other columns are ignored.
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
from faresight.llm.text import mix64

SHARD_KEYS = 50_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """Verdict for URLs of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str


# The fixed rules of the registered query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def url_parts(url: str) -> tuple[Column, Column]:
    """Host and path of a URL column."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


# ---- cascades -------------------------------------------------------------

def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    a = mix64(h1 ^ np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    b = mix64(h2 + np.uint64(level)) | np.uint64(1)
    return ((a[:, None] + np.arange(hashes, dtype=np.uint64)[None, :] * b[:, None]) % np.uint64(bits)).astype(np.int64)


def _passes(level: tuple[int, int, np.ndarray], number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    bits, hashes, words = level
    p = _positions(h1, h2, number, bits, hashes)
    return ((words[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Levels (bits, hashes, bitmap) that separate distinct listed keys from the others exactly."""
    levels: list[tuple[int, int, np.ndarray]] = []
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(inside):
        # So many bits that about as many outsiders pass as there are insiders; a half from level 2 on.
        rate = min(0.5, max(len(inside) / max(len(outside), 1) / 1.4, 1e-6)) if not levels else 0.5
        hashes = max(1, round(-np.log2(rate)))
        bits = max(64, int(np.ceil(len(inside) * hashes / np.log(2))))
        words = np.zeros((bits + 7) // 8, dtype=np.uint8)
        p = _positions(h1[inside], h2[inside], len(levels) + 1, bits, hashes).ravel()
        np.bitwise_or.at(words, p >> 3, (1 << (p & 7)).astype(np.uint8))
        levels.append((bits, hashes, words))
        wrong = outside[_passes(levels[-1], len(levels), h1[outside], h2[outside])] if len(outside) else outside
        inside, outside = wrong, inside
    return levels


def cascade_contains(levels: list, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed (exact for keys of the universe)."""
    answer = np.full(len(h1), len(levels) % 2 == 1)
    live = np.arange(len(h1))
    for number, level in enumerate(levels, 1):
        passed = _passes(level, number, h1[live], h2[live])
        answer[live[~passed]] = number % 2 == 0
        live = live[passed]
    return answer


def _packed(levels: list) -> bytes:
    head = np.array([len(levels), *[x for bits, hashes, _ in levels for x in (bits, hashes)]], dtype=np.int64)
    return head.tobytes() + b"".join(words.tobytes() for *_, words in levels)


def _unpacked(raw: bytes) -> list:
    n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    head = np.frombuffer(raw, dtype=np.int64, count=1 + 2 * n)[1:].reshape(n, 2)
    at, out = 8 * (1 + 2 * n), []
    for bits, hashes in head.tolist():
        size = (bits + 7) // 8
        out.append((bits, hashes, np.frombuffer(raw, dtype=np.uint8, count=size, offset=at)))
        at += size
    return out


def _hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


def _shard(shards: int) -> Column:
    return F.pmod(F.col("h1"), F.lit(shards)).cast("int")


def build_cascades(spark: SparkSession, universe: DataFrame, shards: int) -> DataFrame:
    """``shard, cascade`` from distinct ``h1, h2, listed``; a written table."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (pdf[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        levels = build_cascade(h1, h2, pdf["listed"].to_numpy().astype(bool))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "cascade": [_packed(levels)]})

    made = universe.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(build, "shard int, cascade binary")
    return materialise(spark, made, "cascades")


def mark_by_shard(keys: DataFrame, cascades: DataFrame, shards: int) -> DataFrame:
    """``keys`` (with ``h1, h2``) and ``listed``; keys meet their shard's cascade, salted to groups of bounded size."""
    names = keys.columns
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in keys.schema)}, listed boolean"
    salts = max(1, -(-keys.count() // (shards * SHARD_KEYS)))
    rest = [c for c in names if c not in ("h1", "h2")]
    left = keys.withColumn("_shard", _shard(shards)).withColumn(
        "_salt", F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"))
    right = cascades.withColumnRenamed("shard", "_shard").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def met(a: pa.Table, b: pa.Table) -> pa.Table:
        levels = _unpacked(b.column("cascade")[0].as_py()) if b.num_rows else []
        h1, h2 = (a.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        return a.select(names).append_column("listed", pa.array(cascade_contains(levels, h1, h2), pa.bool_()))

    return left.groupBy("_shard", "_salt").cogroup(right.groupBy("_shard", "_salt")).applyInArrow(met, schema)


def mark_lists(spark: SparkSession, rows: DataFrame, cascades: DataFrame, shards: int, broadcast_bytes: int) -> DataFrame:
    """``rows`` (with an array ``h`` of key hashes) and ``listed``, an array of answers in the same order."""
    size = cascades.agg(F.coalesce(F.sum(F.length("cascade")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        sent = spark.sparkContext.broadcast({r["shard"]: bytes(r["cascade"]) for r in cascades.collect()})

        @F.pandas_udf("array<boolean>")
        def answers(h1: pd.Series, h2: pd.Series) -> pd.Series:
            opened = {s: _unpacked(raw) for s, raw in sent.value.items()}
            sizes = [len(x) for x in h1]
            a, b = (np.concatenate([np.asarray(x, dtype=np.int64) for x in s]) for s in (h1, h2))
            shard, out = a % shards, np.zeros(len(a), dtype=bool)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                out[at] = cascade_contains(opened.get(int(s), []), a[at].view(np.uint64), b[at].view(np.uint64))
            return pd.Series(np.split(out, np.cumsum(sizes)[:-1]), dtype=object)

        return rows.withColumn("listed", answers(F.col("h.h1"), F.col("h.h2")))
    numbered = materialise(spark, rows.withColumn("_row", F.monotonically_increasing_id()), "urls")
    keys = numbered.select("_row", F.posexplode("h")).select("_row", "pos", "col.h1", "col.h2")
    marked = mark_by_shard(keys, cascades, shards)
    gathered = marked.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("pos", "listed"))).alias("l"))
    return numbered.join(gathered.select("_row", F.col("l.listed").alias("listed")), "_row").drop("_row")


# ---- URLs -----------------------------------------------------------------

def repeated_addresses(pages: DataFrame, min_pages: int) -> DataFrame:
    """Keys of addresses on ``min_pages`` pages or more (``pages``: host, path)."""
    return pages.filter("host <> ''").groupBy("host", "path").count().filter(
        F.col("count") >= min_pages).select(F.concat(F.lit("a "), "host", "path").alias("key"))


def rule_candidates(rules: tuple[Rule, ...]) -> Column:
    """(text, key) of every place of a URL (``host, path``) at which some rule could stand."""
    lengths = sorted({len(r.path) for r in rules})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.substring(F.col("path"), 1, n)),
                     lambda p: F.array_contains(F.array(*[F.lit(n) for n in lengths]), F.length(p)))
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(F.array_distinct(heads), lambda p: F.concat(s, p))))
    return F.when(F.col("host") != "", both).otherwise(F.array().cast("array<string>"))


def judge_urls(spark: SparkSession, pages: DataFrame, rules: tuple[Rule, ...] = RULES, min_pages: int = 2,
               page_id: str = "page_id", url: str = "url", broadcast_bytes: int = 8 << 20) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed_address`` of every row; see the module's text."""
    host, path = url_parts(url)
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    address = F.concat(F.lit("a "), "host", "path")
    keys = parts.select(F.explode(F.array_append(
        F.transform(rule_candidates(rules), lambda k: F.concat(F.lit("r "), k)), address)).alias("key")).distinct()
    rule_keys = spark.createDataFrame([(f"r {r.host}{r.path}",) for r in rules], "key string")
    listed = repeated_addresses(parts, min_pages).unionAll(rule_keys).withColumn("listed", F.lit(1))
    universe = (keys.withColumn("listed", F.lit(0)).unionAll(listed).select(_hashed(F.col("key")).alias("h"), "listed")
                .groupBy("h.h1", "h.h2").agg(F.max("listed").cast("boolean").alias("listed")))
    universe = materialise(spark, universe, "url-universe")
    shards = max(1, -(-universe.count() // SHARD_KEYS))
    cascades = build_cascades(spark, universe, shards)
    texts = F.array_append(F.transform("c", lambda k: F.concat(F.lit("r "), k)), address)
    rows = parts.withColumn("c", rule_candidates(rules)).select(
        "page_id", "host", "path", "c", F.transform(texts, lambda k: _hashed(k)).alias("h"))
    marked = mark_lists(spark, rows, cascades, shards, broadcast_bytes)
    found = F.filter(F.transform("c", lambda k, i: F.struct(
        F.length(k).alias("n"), k.alias("k"), F.get("listed", i).alias("in"))), lambda x: x["in"])
    best = F.array_max(F.transform(found, lambda x: F.struct(x["n"].alias("n"), x["k"].alias("k"))))["k"]
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.host + r.path, r.verdict)])
    known = F.element_at("listed", -1) & (F.col("host") != "")
    return marked.select("page_id", "host", "path", best.alias("rule"), known.alias("listed_address")).withColumn(
        "verdict", F.coalesce(verdicts[F.col("rule")], F.when(F.col("listed_address"), "block").otherwise("allow")))
