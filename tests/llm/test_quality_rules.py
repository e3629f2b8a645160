import re
from collections import Counter, defaultdict

import duckdb

from faresight.llm import quality_rules as Q
from faresight.llm.registry import SQL, op6_quality_rules
from tests.conftest import SF_SMALL
from tests.llm.helpers import UPPER, WORD

DDL = "doc_id long, text string, source string, n_words int"
LIMITS = Q.QualityLimits(max_documents=2)


def verdicts(rows, limits):
    line_docs = defaultdict(set)
    split = []
    for i, t, host in rows:
        t, host = t or "", host or ""
        lines = [(tuple(WORD.findall(x)), x) for x in t.split("\n")]
        lines = [(" ".join(w).translate(UPPER), len(w), x) for w, x in lines if w]
        split.append(lines)
        for n, k, _ in lines:
            if k <= limits.max_line_words:
                line_docs[host, n].add(t)
    out = []
    for (i, t, host), lines in zip(rows, split):
        t, host = t or "", host or ""
        w = WORD.findall(t)
        windows = Counter(tuple(w[p:p + 8]) for p in range(len(w) - 7))
        covered = {p + o for p in range(len(w) - 7) if windows[tuple(w[p:p + 8])] > 1 for o in range(8)}
        bad = [k for n, k, _ in lines if len(line_docs[host, n]) > limits.max_documents]
        failed = len(w) < limits.min_words or 100 * len(covered) > limits.max_repeat_percent * len(w)
        left = len(w) - sum(bad)
        kept = not failed and left >= limits.min_left_words and left >= limits.min_left_share * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len({x for *_, x in lines}),
                    len(covered), failed, len(bad), left, kept))
    return sorted(out, key=str)


def test_query_against_sql_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    got = sorted((tuple(r) for r in op6_quality_rules(spark, SF_SMALL).collect()), key=str)
    assert got == verdicts([tuple(r) for r in docs], Q.QualityLimits())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    rel = con.sql(f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
                  f"n_removed_lines, n_left_words, kept FROM ({SQL['op6_quality_rules']})")
    assert sorted(rel.fetchall(), key=str) == got


ROWS = [(1, None, "a"), (2, "", None), (3, "word " * 19, "a"), (4, "word " * 20, "a"),
        (5, " ".join(f"w{i}" for i in range(30)), "a"), (6, "x\n\nx\n \ny # * <b>", "b"), (None, "ä\x0bö\x0c É\r\n\x1c", "b"),
        (7, " ".join(f"w{i}" for i in range(40)) + " " + " ".join(f"w{i}" for i in range(8)), "c"),
        (8, "a b " * 3000, "c"), (9, " ".join(f"v{i % 9}" for i in range(9000)), "c")] + [
        (20 + i, " ".join(f"u{i}x{k}" for k in range(30)) + "\nShared  LINE of this host\nshared line of this host", "h") for i in range(4)] + [
        (30 + i, f"n{i} " * 20 + "\nshared line of this host", h) for i, h in enumerate("kl")] + [
        (40 + i, "\n".join(["shared line of this host"] * 5) + " " + " ".join(f"y{i}z{k}" for k in range(5)), "h") for i in range(2)] + [
        (50, "copy of one text with words " * 4 + "\nline of a copy", "q")] * 4


def test_cases(spark):
    docs = spark.createDataFrame([(*r, 7) for r in ROWS], DDL)
    got = sorted((tuple(r) for r in Q.quality_verdicts(docs, LIMITS).collect()), key=str)
    assert got == verdicts(ROWS, LIMITS)
    by = {r[0]: r for r in got}
    assert by[20][7] == 2 and by[30][7] == 0 and by[50][7] == 0  # of a host; copies count once
    assert Q.quality_verdicts(docs.limit(0), LIMITS).collect() == []


def test_apply_removes_lines_and_documents(spark):
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], DDL.replace("n_words", "n_chars"))
    want = {r[0]: r for r in verdicts(ROWS, LIMITS) if r[-1]}
    got = Q.apply_quality_rules(docs, LIMITS)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r["doc_id"] for r in rows} == set(want)
    texts = {r[0]: r[1] for r in ROWS}
    for r in rows:
        assert len(WORD.findall(r["text"])) == want[r["doc_id"]][8] and r["n_chars"] == len(r["text"])
        assert want[r["doc_id"]][7] or r["text"] == texts[r["doc_id"]]
    assert Q.apply_quality_rules(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(*r, 7) for r in ROWS], DDL)
    for q in (Q.quality_verdicts(docs), Q.apply_quality_rules(docs)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
