import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from faresight.llm import merkle as M
from faresight.llm.registry import op13_merkle_manifest
from tests.conftest import SF_SMALL

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def leaf(r, text):
    out = ""
    for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def climb(nodes):
    """Top and, for each node, the (left, right) siblings bottom up."""
    paths, at, where = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(at) > 1:
        for i, w in enumerate(where):
            first = w // 3 * 3
            paths[i].append((at[first:w], at[w + 1:first + 3]))
        where = [w // 3 for w in where]
        at = [h("".join(at[i:i + 3])) for i in range(0, len(at), 3)]
    return at[0], paths


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in sources:
        by[s].sort(key=lambda x: x[:3])
        done[s] = climb([x[2] for x in by[s]])
    root, top_paths = climb([done[s][0] for s in sources])
    out = []
    for s, top_path in zip(sources, top_paths):
        for (_, _, own, r), path in zip(by[s], done[s][1]):
            node, full = own, path + top_path
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                node = leaf(r, r["text"].replace("\n", ""))
            for left, right in full:
                node = h("".join([*left, node, *right]))
            proof = h("".join(d for left, right in full for d in [*left, *right]))
            out.append((r["doc_id"], own, done[s][0], root, proof, node, node == root))
    return out


def key(row):
    return tuple(str(x) for x in row)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                               "verified").collect()), key=key)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = result(op13_merkle_manifest(spark, SF_SMALL))
    assert got == sorted(brute(rows), key=key)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_blocks_of_several_rounds(spark):
    rows = [(i, f"line {i}\nmore", "en", f"s{i % 7 and 1}{i % 2 and 'x'}", i) for i in range(100)]
    df = spark.createDataFrame(rows, DDL)
    for levels in (1, 2):
        assert result(M.tamper_report(spark, df, levels)) == sorted(brute(df.collect()), key=key)


def test_cases(spark):
    rows = [(1, "a\nb", "en", None, 3), (1, "a\nb", "en", None, 3), (None, None, None, "b", None), (None, "x", None, "b", None),
            (5, "", None, "", 0), (6, "\n", "de", "é", 1), (7, "w " * 200_000 + "\n", "en", "a", None), (8, "t", "en", "b", 1)]
    df = spark.createDataFrame(rows, DDL)
    clash = df.withColumn("tree", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("_row", F.lit(3)).withColumn("digest", F.lit(4))
    assert result(M.tamper_report(spark, clash)) == sorted(brute(df.collect()), key=key)
    assert M.tamper_report(spark, df.limit(0)).count() == 0
    one = df.filter("doc_id = 5")
    assert result(M.tamper_report(spark, one)) == sorted(brute(one.collect()), key=key)


def test_versions_share_untouched_nodes():
    digests = [bytes([i]) * 32 for i in range(27)]
    tree = M.Tree(digests, 3)
    version = tree.put(13, b"x" * 32)
    assert version.top != tree.top and tree.top == M.Tree(digests, 3).top
    assert version.top == M.Tree([*digests[:13], b"x" * 32, *digests[14:]], 3).top
    old, new = tree.node, version.node
    for turn in (1, 1, 1):      # the way from the top to leaf 13
        assert all(old[1][i] is new[1][i] for i in range(3) if i != turn)
        old, new = old[1][turn], new[1][turn]
    assert version.put(13, digests[13]).top == tree.top


def test_a_source_with_most_rows_is_dealt_by_block(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("tree"), F.lit(b"d" * 32).alias("digest"))
    placed = M.positions(spark, df, ["doc_id", "digest"])
    got = placed.select("doc_id", "pos", "n").collect()
    assert all(r["doc_id"] == r["pos"] and r["n"] == 4000 for r in got)
    same = df.withColumn("doc_id", F.lit(1).cast("long"))
    assert sorted(r["pos"] for r in M.positions(spark, same, ["doc_id", "digest"]).collect()) == list(range(4000))
