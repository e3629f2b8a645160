import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from faresight.llm import token_counts as T
from faresight.llm.registry import VOCABULARY, op2_token_counts
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, "rb") as f:
        return T.TokenCounter(f.read(), public_tokenizers.PATTERN)


def applied(text, edits):
    for begin, removed, inserted in edits:
        begin = min(max(begin, 0), len(text))
        text = text[:begin] + inserted + text[begin + max(removed, 0):]
    return text


def test_query_against_full_counts(spark, counter):
    docs = documents(spark, SF_SMALL)
    got = op2_token_counts(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    saved = 0
    for r in got:
        t = docs[r["doc_id"]]["text"] or ""
        n = len(t)
        assert r["n_tokens"] == len(counter.encoding.encode_ordinary(t))
        new = applied(t, [(n // 4, 16, ""), (n // 2, 0, t[:16]), (n, 0, t[-16:])])
        assert r["edited_chars"] == len(new)
        assert r["edited_tokens"] == len(counter.encoding.encode_ordinary(new)), r["doc_id"]
        saved += r["encoded_chars"] < len(new) / 2
    assert saved > 0.5 * len(got)


def test_random_edits_equal_full_counts(counter):
    rng = random.Random(3)
    letters = "ab'sre  \n\t1!è"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        tree = T.CountTree(text, counter)
        for _ in range(8):
            begin, removed = rng.randint(-2, len(text) + 3), rng.choice((0, 0, 1, 2, 5, 70))
            inserted = "".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 2, 9, 40))))
            text = applied(text, [(begin, removed, inserted)])
            tree.edit(begin, removed, inserted)
            assert tree.text == text
            assert tree.n_tokens == len(counter.encoding.encode_ordinary(text)), (text, begin, removed, inserted)
            assert tree.chars[1] == len(text)


def test_only_the_touched_region_is_encoded(counter):
    text = "some plain words of a longer text " * 2000
    tree = T.CountTree(text, counter)
    tree.edit(30_000, 3, "other")
    assert tree.encoded < 60
    assert tree.n_tokens == len(counter.encoding.encode_ordinary(tree.text))


def test_cases(spark, counter):
    edits = "array<struct<begin: long, removed: long, inserted: string>>"
    rows = [(1, None, None), (2, "", [(0, 0, "new text")]), (None, "abc", []), (3, "abc def", [(99, 5, " x"), (0, 99, "")]),
            (3, "abc def", [(1, None, None)])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edited_tokens {edits}")
    got = T.count_with_edits(spark, docs, F.col("edited_tokens"), PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == 5
    by = {(r["doc_id"], r["n_edits"]): r for r in got}
    assert by[1, 0]["n_tokens"] == by[1, 0]["edited_tokens"] == 0
    assert by[2, 1]["edited_tokens"] == len(counter.encoding.encode_ordinary("new text"))
    assert by[3, 2]["edited_tokens"] == 0 and by[3, 2]["edited_chars"] == 0
    assert by[3, 1]["edited_tokens"] == by[3, 1]["n_tokens"]
    none = T.count_with_edits(spark, docs.limit(0), F.col("edited_tokens"), PATH, public_tokenizers.PATTERN)
    assert none.collect() == []
