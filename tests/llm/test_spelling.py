import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from faresight.llm import spelling as S
from faresight.llm.registry import op11_spelling
from tests.conftest import SF_SMALL
from tests.llm.helpers import UPPER

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, every=31, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    holes = defaultdict(set)      # words by what is left without one code point, for a faster search
    for w in words:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    close = defaultdict(set)
    for group in holes.values():
        for a in group:
            close[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words.get(form[w])))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = result(op11_spelling(spark, SF_SMALL))
    assert got == brute(rows)
    assert any(r[1] for r in got)


def test_dense_words_and_chains(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(150)]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(30)]
    for n, w in ((1, "kkkkkkkx"), (12, "kkkkkkkk"), (150, "kkkkkkk"), (2000, "kkkkkkkkk"), (2, "zzzzzzzz"), (20, "zzzzzzzy"), (20, "zzzzzzzx")):
        rows.append((None, f"{w} " * 2 * n))
    plan = S.SpellingPlan()
    assert result(S.spelling_variants(spark, frame(spark, rows), plan)) == brute(rows, every=0)
    assert result(S.spelling_variants(spark, frame(spark, rows), plan, S.drop_letter(5))) == brute(rows, every=5)


def test_long_words(spark):
    # around the length at which rotations are listed by hash, and far above it
    rng = random.Random(9)
    made = []
    for length in (61, 62, 63, 64, 65, 66, 400, 3000):
        base = "".join(rng.choice("abc") for _ in range(length))
        made += [base, base[:30] + "z" + base[31:], base[:12] + base[13:], base + "q", base[0] + base]
    rows = [(i, f"{w} {w}") for i, w in enumerate(made)] + [(99, f"{made[0]} " * 40)]
    assert result(S.spelling_variants(spark, frame(spark, rows))) == brute(rows, every=0)


def test_cases(spark):
    rows = [(1, None), (2, ""), (None, "ÉCOLEée ÉCOLEée Écoleée"), (4, "STRASSE Strasse strasse"), (4, "STRASSE Strasse strasse"),
            (5, "short wor7ds only"), (6, "École×÷Aaa École×÷Aaa"), (7, "abcdefg\x00abcdefg 1abcdefgh2abcdefgh")]
    df = frame(spark, rows)
    clash = df.withColumn("word", F.lit(1)).withColumn("id", F.lit(1)).withColumn("n", F.lit(1)).withColumn("_text", F.lit(""))
    assert result(S.spelling_variants(spark, clash)) == brute(rows, every=0)
    assert S.spelling_variants(spark, df.limit(0)).count() == 0
    assert S.spelling_variants(spark, frame(spark, [(1, "a b c")])).count() == 0


def test_ranges_are_bounded_by_the_alphabet(spark):
    # 2,000 misspellings of one word: no range holds more than one listing for each letter and the whole rotation
    rng = random.Random(8)
    words = {"misspelling"[:i] + c + "misspelling"[i + d:] for i in range(11) for c in "abcdefghijklmnopqrstuvwxyzàáâãäåæçè" for d in (0, 1)}
    listed = Counter(k for w in words for k, _, _ in S.rotation_keys(w))
    assert max(listed.values()) <= 36
    rows = [(i, " ".join(rng.choices(sorted(words), k=20))) for i in range(60)] + [(100, "misspelling " * 300)]
    assert result(S.spelling_variants(spark, frame(spark, rows))) == brute(rows, every=0)
