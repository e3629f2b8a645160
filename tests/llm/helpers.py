"""Plain Python versions of the definitions, for comparison."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingles(text, k=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


def documents(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
