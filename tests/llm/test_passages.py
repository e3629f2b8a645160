import random

import numpy as np

from faresight.llm import passages as P
from faresight.llm.registry import op3_substring_dedup
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORD, documents, shingles

DDL = "doc_id long, text string, n_chars int, place string"


def prose(rng, n):
    """n words in sentences of 6 to 14 words, two or three sentences a line."""
    out, left = [], n
    while left > 0:
        k = min(left, rng.randint(6, 14))
        out.append(" ".join(f"w{rng.randrange(10**7)}" for _ in range(k)) + ".")
        left -= k
    return "".join(s + rng.choice((" ", " ", "\n")) for s in out).strip()


def cleaned(spark, texts):
    docs = spark.createDataFrame([(i, t, len(t or ""), "p") for i, t in texts.items()], DDL).repartition(3)
    got = P.dedup_passages(spark, docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["n_chars"] == len(r["text"] or "") and r["place"] == "p"
    return {r["doc_id"]: r["text"] for r in rows}


def test_planted_passages_leave_all_but_the_first_document(spark):
    rng = random.Random(1)
    texts = {i: prose(rng, rng.randint(80, 300)) for i in range(40)}
    clean = dict(texts)
    planted = {}
    for i in range(40, 100):
        passage = planted.setdefault(i % 12, prose(rng, rng.randint(51, 120)))
        before, after = prose(rng, rng.randint(10, 120)), prose(rng, rng.randint(10, 120))
        # in a line of its own, or in the middle of one
        texts[i] = f"{before}\n{passage}\n{after}" if i % 3 else f"{before[:-1]} {passage} {after}"
    got = cleaned(spark, texts)
    assert all(got[i] == t for i, t in clean.items())
    for k, passage in planted.items():
        holders = [i for i in range(40, 100) if i % 12 == k]
        assert got[holders[0]] == texts[holders[0]]
        w = WORD.findall(passage)
        for i in holders[1:]:
            left = set(WORD.findall(got[i]))
            assert sum(x in left for x in w) < 0.5 * len(w), (k, i)
            own = set(WORD.findall(texts[i])) - set(w)
            assert len(own - left) <= len(w) / 3  # a line that is nearly the passage goes as a whole


def test_near_copies_of_a_long_line(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**7)}" for _ in range(90)]
    other = list(words)
    other[30] = "changed"
    texts = {1: prose(rng, 60) + "\n" + " ".join(words) + "\nend of one", 2: "begin\n" + " ".join(other) + "\n" + prose(rng, 60),
             3: "begin\n" + " ".join(f"v{k}" for k in range(90)) + "\nend"}
    got = cleaned(spark, texts)
    assert got[1] == texts[1] and got[3] == texts[3]
    assert "changed" not in got[2] and got[2].startswith("begin\n")


def test_short_shared_lines_stay(spark):
    rng = random.Random(3)
    line = "All rights of this page are reserved by its owner."
    texts = {i: f"{prose(rng, 60)}\n{line}\n{prose(rng, 60)}" for i in range(30)}
    assert cleaned(spark, texts) == texts


def test_query_leaves_no_long_repeats(spark):
    docs = documents(spark, SF_SMALL)
    got = {r["doc_id"]: r for r in op3_substring_dedup(spark, SF_SMALL).collect()}
    assert set(got) == set(docs)

    def repeats(texts, k=60):
        first, again = {}, 0
        for i in sorted(texts):
            own = shingles(texts[i], k) if len(WORD.findall(texts[i])) >= k else set()
            again += sum(first.setdefault(s, i) != i for s in own)
        return again

    before, after = (repeats(t) for t in ({i: r["text"] for i, r in docs.items()}, {i: r["text"] for i, r in got.items()}))
    assert before > 100 and after < 0.1 * before
    changed = sum(got[i]["text"] != docs[i]["text"] for i in docs)
    assert changed == sum(r["removed_spans"] > 0 for r in got.values())
    for i, r in got.items():
        assert len(WORD.findall(docs[i]["text"])) - len(WORD.findall(r["text"])) == r["removed_words"]


def test_cases(spark):
    rng = random.Random(4)
    passage = prose(rng, 80)
    rows = [(1, None, 0, "x"), (2, "", 0, "x"), (None, passage, 0, "x"), (5, passage, 0, "x"), (5, passage, 0, "x"),
            (9, passage, 0, "x"), (10, passage + "\n" + "no stops here " * 30_000, 0, "x"), (11, ". . . !", 0, None)]
    docs = spark.createDataFrame(rows, DDL)
    got = P.clean_passages(spark, docs).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in got:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[1] == [None] and texts[2] == [""] and texts[11] == [". . . !"]
    assert texts[None] == [passage] and texts[5] == [passage, passage]
    assert texts[9] == [""] and texts[10][0].startswith("no stops")
    assert P.dedup_passages(spark, docs.limit(0)).collect() == []


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "q")], "doc_id long, text string, _spans int, component_id string")
    [row] = P.dedup_passages(spark, docs).collect()
    assert tuple(row) == (1, "a b c", 5, "q")


def test_sentences_are_cut_alike_in_both_copies():
    rng = random.Random(6)
    for stops in (True, False):
        passage = prose(rng, 70) if stops else " ".join(f"w{rng.randrange(10**7)}" for _ in range(70))
        a = f"{prose(rng, 33)[:-1]} {passage} tail one."
        b = f"other beginning {passage}\nand more"
        x, y = P.Sentences([a.encode()]), P.Sentences([b.encode()])
        common = set(x.hash.tolist()) & set(y.hash.tolist())
        assert sum(int(n) for h, n in zip(x.hash.tolist(), x.size) if h in common) >= 25


def test_spans():
    text = "keep this. drop this part. keep that\nline".encode()
    assert P.without_spans(text, [(11, 26)]) == b"keep this. keep that\nline"
    assert P.without_spans(b"drop me\nkeep", [(0, 7)]) == b"keep"
    assert P.without_spans(b"keep\ndrop me\nkeep", [(5, 12)]) == b"keep\nkeep"
    assert P.without_spans(b"all", [(0, 3)]) == b""
    assert P.without_spans(b"a", []) == b"a"
    assert np.array_equal(P.Sentences([b"", b" "]).first, [])


def naive_seeds(words):
    """(place, 13 words) of each window that is the smallest by hash of 13 neighbouring ones."""
    k = P.SEED
    windows = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    value = {x: int(v) for x, v in zip(windows, window_hashes(words))}
    out = set()
    for i in range(len(windows) - k + 1):
        least = min(value[x] for x in windows[i:i + k])
        out |= {(j, windows[j]) for j in range(i, i + k) if value[windows[j]] == least}
    return out


def window_hashes(words):
    """Hashes of all windows, each from a text of its words alone."""
    k = P.SEED
    out = []
    for i in range(len(words) - k + 1):
        s = P.Sentences([" ".join(words[i:i + k]).encode()])
        total = (s._sums[k:] - s._sums[:1]) * s._inverse[:1]
        out.append(int((~P.mix64(total + np.uint64(k)))[0]))
    return out


def test_seeds_are_those_of_the_definition_whatever_the_neighbouring_texts():
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(9)}" for _ in range(n)) for n in (0, 1, 12, 13, 24, 25, 26, 60, 0, 140)]
    texts.append(" ".join(["again"] * 40))
    s = P.Sentences([t.encode() for t in texts])
    first, value = s.seeds()
    got = {}
    for a in first.tolist():
        i = int(s.words.text[a])
        got.setdefault(i, set()).add(a - int(s.words.first[i]))
    for i, t in enumerate(texts):
        assert got.get(i, set()) == {j for j, _ in naive_seeds(t.split())}, i
        alone = P.Sentences([t.encode()]).seeds()
        assert set(alone[0].tolist()) == got.get(i, set())
    assert len(P.Sentences([]).seeds()[0]) == 0


def test_equal_runs_share_a_seed_and_seeds_leave_no_gap():
    rng = random.Random(8)
    for n in (25, 40, 51, 90):
        run = [f"w{rng.randrange(500)}" for _ in range(n)]
        places = []
        for _ in range(2):
            before = [f"x{rng.randrange(500)}" for _ in range(rng.randrange(30))]
            after = [f"y{rng.randrange(500)}" for _ in range(rng.randrange(30))]
            first, _ = P.Sentences([" ".join(before + run + after).encode()]).seeds()
            places.append({a - len(before) for a in first.tolist() if 0 <= a - len(before) <= n - P.SEED})
        common = sorted(places[0] & places[1])
        assert common and common[0] < P.SEED and common[-1] + P.SEED > n - P.SEED
        assert all(b - a <= P.SEED for a, b in zip(common, common[1:]))


def test_passages_cut_out_anywhere_leave_all_but_their_edges(spark):
    """51 words from a random place of a document, put inside a line of two others; without stops too."""
    rng = random.Random(9)
    texts, planted = {}, []
    for k in range(60):
        stops = k % 2 == 0
        words = prose(rng, 200).split() if stops else [f"w{rng.randrange(10**7)}" for _ in range(200)]
        a = rng.randrange(150)
        passage = words[a:a + 51]
        texts[3 * k] = " ".join(words)
        for d in (1, 2):
            own = [" ".join(f"v{rng.randrange(10**7)}" for _ in range(rng.randrange(20, 60))) for _ in range(2)]
            texts[3 * k + d] = f"{own[0]} {' '.join(passage)} {own[1]}"
            planted.append((3 * k + d, {x.strip(".") for x in passage}, set(WORD.findall(" ".join(own)))))
    got = cleaned(spark, texts)
    assert all(got[3 * k] == texts[3 * k] for k in range(60))
    for i, passage, own in planted:
        left = {x.strip(".") for x in WORD.findall(got[i])}
        assert len(passage & left) <= 2 * (P.SEED - 1), i
        assert own <= set(WORD.findall(got[i])), i  # nothing else goes


def test_short_equal_runs_stay(spark):
    rng = random.Random(10)
    phrase = " ".join(f"w{rng.randrange(10**7)}" for _ in range(19))
    texts = {i: f"{prose(rng, 40)[:-1]} {phrase} {prose(rng, 40)}" for i in range(10)}
    assert cleaned(spark, texts) == texts


def test_parts_do_not_depend_on_the_texts_beside():
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(10**7)}" for _ in range(rng.randint(41, 90))).encode() for _ in range(200)]
    together = P.Sentences(texts)
    for i, t in enumerate(texts):
        own = together.text == i
        assert together.hash[own].tolist() == P.Sentences([t]).hash.tolist(), i


def test_parts_are_cut_and_shuffled_once_and_a_frequent_one_is_dealt_apart(spark):
    common = "this very common sentence is in every text here."
    texts = [(i, f"{common} words of text {i} alone make this sentence.") for i in range(300)]
    docs = spark.createDataFrame([*texts, (7, common)], "doc_id long, text string").coalesce(1)
    parts = P.repeated_parts(docs)
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Aggregate" not in plan
    assert sorted(map(tuple, parts.collect())) == sorted([(i, 0) for i in range(1, 300)] + [(7, 0)])
    rows = docs.mapInArrow(P._repeat_rows(P.PassagePlan()), "h long, doc_id long, place int, known int")
    h = rows.groupBy("h").count().orderBy("count", ascending=False).first()["h"]
    met = rows.filter(rows.h == h).groupBy("known").count().collect()
    assert max(r["count"] for r in met) < 20 and sum(r["count"] for r in met) == 301


def test_later_rows_are_those_after_a_smaller_document():
    h, doc = np.array([5, 3, 5, 5, 9, 3]), np.array([4, 2, 2, 2, 1, 8])
    assert P._later(h, doc).tolist() == [True, False, False, False, False, True]
    assert P._later(h[:0], doc[:0]).tolist() == []
