"""MinHash near-dedup with sequential Bayesian verification.

Documents are linked when the Jaccard similarity of their sets of distinct
5-word shingles is at least 0.75 (``100 * intersection >= 75 * union``).

1. One pass over the texts gives each document its set's size, a 128-bit hash
   of the set and a MinHash signature (128 values of 16 bits).  Documents with
   equal sets form one class; from here on only the class's smallest doc_id
   stands for it, however many copies there are.
2. Banding: 32 bands of 4 values.  A pair at the threshold shares no band with
   a chance of 5e-6.  A bucket with few members gives all its pairs.  A large
   bucket gives a star, every member with the smallest.  The links found are
   contracted to components, and only large buckets whose members are still in
   different components go on to step 5.
3. Sequential Bayesian verification: signatures of a candidate pair are
   compared 16 values at a time.  With a uniform prior the similarity after m
   comparisons with k matches is Beta(k + 1, m - k + 1); a pair is pruned as
   soon as P(similarity >= 0.75) is below ``miss`` (1e-6 for each look).
4. Survivors are verified exactly on full shingle sets, computed again from
   the whole texts, and links are contracted to components.
5. Large buckets that are still mixed: buckets with members in common make one
   group, which is divided ``DIVISIONS`` times by two bands, for pairs and
   stars as above; that only adds candidates. A group's common set C holds the
   shingles of more than half of its members, and each member is kept as its
   difference D = set ^ C. A pair is linked if 7 * |D_x ^ D_y| <= n_x + n_y.
   With u = 7 * |D| - n that is certain where u_x + u_y <= 0, and such pairs
   are linked through the member of least u; any other linked pair shares (u_x
   + u_y) / 14 elements of D at least. So an ordered prefix of each D is enough
   to meet (shingles outside C first, hardly ever held twice), and the members
   that share an element of their prefixes are compared: few ones as pairs,
   many in blocks of bounded size, exactly, by counts of
   common elements within the block, which returns a forest of true links, at most one row a member. So
   every pair that shares a band is compared, or its members are linked
   otherwise.

Cases: a text that is null, empty or without words has an empty set and is
linked with nothing; a text with one to four words has its whole sequence as
its one shingle; rows that repeat a doc_id are one document (linked if any of
its texts is similar); a row with a null doc_id stands alone (its component is
null and it is kept); an empty table gives an empty result; columns other than
the two named ones are ignored here and kept by ``near_dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.tables import connected_components, contracted, materialise
from faresight.llm.text import GROUP_BYTES, Words, distinct_shingle_sets, groups, random_words

THRESHOLD_PERCENT = 75
MISS = 1e-6
SMALL_BUCKET = 8
BLOCK, SPAN = 1024, 2048
SALTS = 64
BLOCK_ELEMENTS = 1 << 22  # of the differences held by a block or span
DIVISIONS = 8


@dataclass(frozen=True)
class Banding:
    """Signature of ``rows * bands`` values; ``look`` of them are compared at a time."""

    rows: int = 4
    bands: int = 32
    look: int = 16

    @property
    def values(self) -> int:
        return self.rows * self.bands


_SIGNED = "doc_id long, n_shingles long, set_hash binary, sig binary"


def _signer(plan: Banding) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    mult, add = random_words(plan.values, 101) | np.uint64(1), random_words(plan.values, 102)

    def signatures(batches):
        for batch in batches:
            yield from _signed_groups(batch, mult, add)

    return signatures


def _signed_groups(batch: pa.RecordBatch, mult: np.ndarray, add: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids = batch.column("doc_id")
    for begin, encoded in groups(batch.column("text")):
        values, bounds = Words(encoded).shingles()
        some = np.flatnonzero(np.diff(bounds))
        sig = np.empty((len(some), len(mult)), dtype=np.uint16)
        for i in range(len(mult) if len(some) else 0):
            low = np.minimum.reduceat(values * mult[i] + add[i], bounds[some])
            sig[:, i] = (low ^ (low >> np.uint64(32))) & np.uint64(0xFFFF)
        size: list = [0] * len(encoded)
        set_hash: list = [None] * len(encoded)
        packed: list = [None] * len(encoded)
        for row, i in enumerate(some):
            distinct = np.unique(values[bounds[i]:bounds[i + 1]])
            size[i] = len(distinct)
            set_hash[i] = hashlib.md5(distinct.tobytes()).digest()
            packed[i] = sig[row].tobytes()
        yield pa.RecordBatch.from_arrays(
            [ids.slice(begin, len(encoded)), pa.array(size, pa.int64()), pa.array(set_hash, pa.binary()),
             pa.array(packed, pa.binary())], ["doc_id", "n_shingles", "set_hash", "sig"])


@cache
def fewest_matches(values: int, look: int, threshold: float = THRESHOLD_PERCENT / 100,
                   miss: float = MISS) -> dict[int, int]:
    """For each number m of values compared, the fewest matches that stay in.

    With k matches of m under a uniform prior, P(similarity >= t) equals
    P(Binomial(m + 1, t) <= k).
    """
    out = {}
    for m in range(look, values + 1, look):
        tail, k = 0.0, -1
        while tail < miss:
            k += 1
            tail += comb(m + 1, k) * threshold ** k * (1 - threshold) ** (m + 1 - k)
        out[m] = k
    return out


def bayes_survivors(sig_a: np.ndarray, sig_b: np.ndarray, look: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (pairs) that no look prunes, and their numbers of matches."""
    live = np.arange(len(sig_a))
    matches = np.zeros(len(sig_a), dtype=np.int64)
    for m, least in fewest_matches(sig_a.shape[1], look).items():
        part = slice(m - look, m)
        matches[live] += (sig_a[live, part] == sig_b[live, part]).sum(axis=1)
        live = live[matches[live] >= least]
    return live, matches[live]


def _stack(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(len(column), -1)


def _pruner(look: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def prune(frames):
        for pdf in frames:
            if len(pdf):
                live, matches = bayes_survivors(_stack(pdf["sig_a"]), _stack(pdf["sig_b"]), look)
                yield pd.DataFrame({"a": pdf["a"].to_numpy()[live], "b": pdf["b"].to_numpy()[live], "matches": matches})

    return prune


def _similar(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose full sets reach the threshold; one side's set is kept while it repeats."""
    last, kept = None, None
    for pdf in frames:
        a_out, b_out = [], []
        for (a, b, text_a), set_b in zip(pdf[["a", "b", "text_a"]].itertuples(index=False, name=None),
                                         distinct_shingle_sets(pdf["text_b"])):
            if last != text_a:
                last, kept = text_a, next(distinct_shingle_sets([text_a]))
            common = len(np.intersect1d(kept, set_b, assume_unique=True))
            if common and 100 * common >= THRESHOLD_PERCENT * (len(kept) + len(set_b) - common):
                a_out.append(a)
                b_out.append(b)
        yield pd.DataFrame({"a": a_out, "b": b_out}, dtype="int64")


def _block_pairs(look: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Bayes survivors between a block of a bucket's outside members and a span of all its members."""
    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"a": [], "b": [], "matches": []}, dtype="int64")]
        side = pdf["side"].to_numpy()
        left, right = pdf[side], pdf[~side]
        if len(left) and len(right):
            sig, ids, comp, outside = _stack(right["sig"]), *(right[c].to_numpy() for c in ("id", "comp", "outside"))
            for one, i, own in zip(_stack(left["sig"]), left["id"].to_numpy(), left["comp"].to_numpy()):
                # Two outside members meet twice; the smaller one's turn counts.
                others = np.flatnonzero((comp != own) & (~outside | (ids > i)))
                if len(others):
                    live, matches = bayes_survivors(np.broadcast_to(one, (len(others), len(one))), sig[others], look)
                    to = ids[others[live]]
                    found.append(pd.DataFrame({"a": np.minimum(i, to), "b": np.maximum(i, to), "matches": matches}))
        return pd.concat(found).astype("int64")

    return pairs


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """A forest of the true links between a block of outside members and a span of all members.

    A member's common elements with all members of the span are counted at
    once, through the list of the members that hold each element.
    """
    found: list[tuple[int, int]] = []
    side = pdf["side"].to_numpy()
    if side.any() and not side.all():
        ids, u, diffs = pdf["id"].to_numpy(), pdf["u"].to_numpy(), pdf["diff"].to_numpy()
        # Rows of one component are one part already; parts are merged as links are found.
        part = np.unique(pdf["comp"].to_numpy(), return_inverse=True)[1]
        right = np.flatnonzero(~side)
        sizes = np.array([len(diffs[k]) for k in right])
        elements = np.concatenate([np.empty(0, np.int64), *(diffs[k] for k in right)])
        order = np.argsort(elements, kind="stable")
        elements, holders = elements[order], np.repeat(np.arange(len(right)), sizes)[order]
        for i in np.flatnonzero(side):
            if (part[right] == part[i]).all():
                continue
            first = np.searchsorted(elements, diffs[i], side="left")
            count = np.searchsorted(elements, diffs[i], side="right") - first
            at = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
            common = np.bincount(holders[at], minlength=len(right))
            # 7 * |D_x ^ D_y| <= n_x + n_y
            near = right[14 * common >= u[i] + u[right]]
            for k in near[np.unique(part[near], return_index=True)[1]]:
                if part[k] != part[i]:
                    found.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
                    part[part == part[k]] = part[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


_MEMBER = "grp long, id long, n long, shingles array<long>"
_DIFFERENCE = "grp long, id long, n long, u long, diff array<long>"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets of the texts of groups' members, one group of texts at a time."""
    for batch in batches:
        for begin, encoded in groups(batch.column("text")):
            values, bounds = Words(encoded).shingles()
            at, sets = [], []
            for i in range(len(encoded)):
                distinct = np.unique(values[bounds[i]:bounds[i + 1]])
                if len(distinct):
                    at.append(begin + i)
                    sets.append(distinct.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp").take(pa.array(at, pa.int64())), batch.column("id").take(pa.array(at, pa.int64())),
                 pa.array([len(x) for x in sets], pa.int64()), _lists(sets)], ["grp", "id", "n", "shingles"])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list column of int64 arrays."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member's shingles outside its group's common set, then the common ones that it lacks, each by value."""
    for batch in batches:
        sets, commons, n = batch.column("shingles"), batch.column("common"), batch.column("n").to_numpy()
        begin = 0
        while begin < len(n):
            end = begin + max(1, int(np.searchsorted(np.cumsum(n[begin:]), GROUP_BYTES // 8)))  # about a megabyte
            diffs = []
            for i in range(begin, end):
                own = sets[i].values.to_numpy()
                common = commons[i].values.to_numpy() if commons[i].is_valid else np.empty(0, np.int64)
                diffs.append(np.concatenate([np.setdiff1d(own, common), np.setdiff1d(common, own)]))
            part = batch.slice(begin, end - begin)
            u = 7 * np.array([len(d) for d in diffs], dtype=np.int64) - n[begin:end]
            yield pa.RecordBatch.from_arrays(
                [part.column("grp"), part.column("id"), part.column("n"), pa.array(u), _lists(diffs)],
                ["grp", "id", "n", "u", "diff"])
            begin = end


class _Links:
    """Verified links so far, and the components they make."""

    def __init__(self, spark: SparkSession, signed: DataFrame, docs: DataFrame, plan: Banding):
        self.spark, self.signed, self.docs, self.plan = spark, signed, docs, plan
        self.links = materialise(spark, signed.limit(0).select(F.col("id").alias("a"), F.col("id").alias("b")), "links")
        self.components = materialise(
            spark, signed.limit(0).select("id", F.col("id").alias("component")), "components")

    def with_component(self, df: DataFrame, column: str, name: str) -> DataFrame:
        c = self.components.select(F.col("id").alias("_i"), F.col("component").alias("_c"))
        return df.join(c, df[column] == F.col("_i"), "left").select(
            *[df[x] for x in df.columns], F.coalesce("_c", df[column]).alias(name))

    def verify(self, pairs: DataFrame, certain: DataFrame | None = None) -> None:
        """Prune candidate pairs, verify the survivors exactly and contract the links, with ``certain`` ones."""
        x, y = (self.signed.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
                for s in "ab")
        sized = pairs.join(x, "a").join(y, "b").filter(
            100 * F.least("n_a", "n_b") >= THRESHOLD_PERCENT * F.greatest("n_a", "n_b"))
        self.confirm(sized.select("a", "b", "sig_a", "sig_b").mapInPandas(
            _pruner(self.plan.look), "a long, b long, matches long"), certain)

    def confirm(self, survivors: DataFrame, certain: DataFrame | None = None) -> None:
        """Verify pairs exactly and contract the links."""
        texts = self.docs.select("doc_id", "text")
        x, y = (texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
        wanted = materialise(self.spark, survivors.select("a", "b"), "survivors")
        found = (wanted.join(y, "b").join(x, "a").select("a", "b", "text_a", "text_b")
                 .mapInPandas(_similar, "a long, b long"))
        self.add(found if certain is None else found.unionAll(certain))

    def add(self, found: DataFrame) -> None:
        self.links = materialise(self.spark, self.links.unionAll(found), "links")
        self.components = contracted(self.spark, self.links)  # a component's smallest id is not listed


def _bands(signed: DataFrame, plan: Banding) -> DataFrame:
    """``key, id`` of every band of every class."""
    size = 2 * plan.rows
    return signed.select(F.expr(
        f"explode(transform(sequence(0, {plan.bands - 1}), i -> xxhash64(i, substring(sig, i * {size} + 1, {size}))))"
    ).alias("key"), "id")


def _mixed_buckets(links: _Links, keys: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: key, id, comp, n, leader, leader_comp."""
    k = links.with_component(keys, "id", "comp")
    buckets = k.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                   F.min(F.struct("id", "comp")).alias("first"))
    buckets = buckets.filter("lo < hi").select("key", "n", F.col("first.id").alias("leader"),
                                               F.col("first.comp").alias("leader_comp"))
    return materialise(links.spark, k.join(buckets, "key"), "buckets")


def _candidates(mixed: DataFrame) -> DataFrame:
    """All pairs of small buckets and the stars of large ones, between components."""
    members = mixed.filter(F.col("n") <= SMALL_BUCKET).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("id", "comp"))).alias("m"))  # at most SMALL_BUCKET members
    small = members.select(F.explode(F.expr(
        "flatten(transform(m, (x, i) -> transform(filter(m, (y, j) -> j > i and y.comp <> x.comp), "
        "y -> struct(x.id as a, y.id as b))))")).alias("p")).select("p.a", "p.b")
    star = mixed.filter((F.col("n") > SMALL_BUCKET) & (F.col("comp") != F.col("leader_comp"))).select(
        F.col("leader").alias("a"), F.col("id").alias("b"))
    return small.unionAll(star).distinct()


def _divided(links: _Links, large: DataFrame, step: int) -> DataFrame:
    """``key, id`` of large groups' members (``key, id``), dealt by two bands.

    ``DIVISIONS`` times in each step, with bands chosen anew by the group's key.
    """
    size, bands = 2 * links.plan.rows, links.plan.bands
    held = large.join(links.signed.select("id", "sig"), "id")

    def band(t: str) -> str:
        return f"substring(sig, cast(pmod(xxhash64(key, {step}, {t}), {bands}) as int) * {size} + 1, {size})"

    picked = f"xxhash64(key, {step}, t, {band('2 * t')}, {band('2 * t + 1')})"
    return held.select(F.expr(f"explode(transform(sequence(0, {DIVISIONS - 1}), t -> {picked}))").alias("key"), "id")


def _still_mixed(links: _Links, mixed: DataFrame) -> DataFrame:
    large = mixed.filter(F.col("n") > SMALL_BUCKET).select("key", "id")
    return _mixed_buckets(links, large).select("key", "id", "comp", "n")


def _dealt(still: DataFrame, elements: str = "0") -> DataFrame:
    """Bucket members (``key, id, comp`` and more) dealt to blocks and spans of bounded size.

    A pair between two components has a member outside the bucket's largest
    one, so blocks of such members meet spans of all members.  ``elements`` is
    the length of a member's difference, of which a block holds a bounded sum.
    """
    names = still.columns
    parts = still.groupBy("key", "comp").agg(F.count("*").alias("_n"), F.sum(F.expr(elements)).alias("_e"))
    main = F.max(F.struct("_n", "comp", "_e"))
    buckets = parts.groupBy("key").agg(F.sum("_n").alias("_all"), F.sum("_e").alias("_alle"), main.alias("_main")).select(
        "key", F.col("_main.comp").alias("_main"),
        F.ceil(F.greatest(F.col("_all") / SPAN, F.col("_alle") / BLOCK_ELEMENTS)).alias("spans"),
        F.ceil(F.greatest((F.col("_all") - F.col("_main._n")) / BLOCK,
                          (F.col("_alle") - F.col("_main._e")) / BLOCK_ELEMENTS)).alias("blocks"))
    members = still.join(buckets, "key").filter("blocks > 0").withColumn("outside", F.col("comp") != F.col("_main"))
    one = F.lit(1).cast("long")
    left = members.filter("outside").withColumn("side", F.lit(True)).withColumn(
        "block", F.pmod(F.xxhash64("id"), "blocks") + 1).withColumn("span", F.explode(F.sequence(one, F.col("spans"))))
    right = members.withColumn("side", F.lit(False)).withColumn(
        "span", F.pmod(F.xxhash64("id", F.lit(1)), "spans") + 1).withColumn(
        "block", F.explode(F.sequence(one, F.col("blocks"))))
    names = [*names, "outside", "side", "block", "span"]
    return left.select(*names).unionAll(right.select(*names))


def _in_blocks(links: _Links, still: DataFrame) -> DataFrame:
    """Survivors among all pairs of the buckets' members, in blocks of bounded size."""
    dealt = _dealt(still.select("key", "id", "comp"))
    return dealt.join(links.signed.select("id", "sig"), "id").groupBy("key", "block", "span").applyInPandas(
        _block_pairs(links.plan.look), "a long, b long, matches long").distinct()


def _groups(links: _Links, still: DataFrame) -> DataFrame:
    """``id, grp`` of the members of mixed buckets (``key, id``); buckets with members in common make a group."""
    first = still.groupBy("key").agg(F.min("id").alias("_first"))
    groups_of = connected_components(links.spark, still.join(first, "key").filter("id > _first"), "id", "_first")
    return materialise(links.spark, groups_of.select("id", F.col("component").alias("grp")), "groups")


def _group_differences(links: _Links, wanted: DataFrame) -> DataFrame:
    """``grp, id, n, u, diff`` of the members of groups (``id, grp``)."""
    spark = links.spark
    texts = links.docs.join(wanted, links.docs["doc_id"] == wanted["id"]).groupBy(
        "grp", "id", F.md5("text").alias("_t")).agg(F.min("text").alias("text"))  # rows that repeat a doc_id
    members = materialise(spark, texts.select("grp", "id", "text").mapInArrow(_members, _MEMBER), "members")
    # A group's size meets each of its shingles: dealt by SALTS parts of them, as a large group has many.
    sizes = members.groupBy("grp").agg(F.count("*").alias("_all")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = members.select("grp", F.explode("shingles").alias("e")).groupBy("grp", "e").agg(F.count("*").alias("_n"))
    # at most twice the mean size of the group's sets
    held = held.filter("_n > 1").withColumn("_part", F.pmod("e", F.lit(SALTS)).cast("int"))
    common = materialise(spark, held.join(sizes, ["grp", "_part"]).filter("2 * _n > _all").groupBy("grp").agg(
        F.sort_array(F.collect_list("e")).alias("common")), "common")
    return materialise(spark, members.join(common, "grp", "left").mapInArrow(_differences, _DIFFERENCE), "differences")


def _prefix_buckets(links: _Links, diffs: DataFrame) -> DataFrame:
    """Mixed buckets of members that share an element of their prefixes: key, grp, id, comp, n, leader, leader_comp."""
    k = links.with_component(diffs.select("grp", "id", "n", "u", "diff"), "id", "comp")
    k = materialise(links.spark, k, "placed")
    tops = k.groupBy("grp").agg(F.min(F.struct("u", "comp")).alias("_m"), F.max("n").alias("_most"))
    rest = k.join(tops, "grp").filter(F.col("comp") != F.col("_m.comp")).groupBy("grp").agg(F.min("u").alias("_rest"))
    placed = k.join(tops.join(rest, "grp"), "grp")
    # u of any partner in another component, and the size of any partner at most
    low = F.when(F.col("comp") == F.col("_m.comp"), F.col("_rest")).otherwise(F.col("_m.u"))
    most = F.least(F.expr("4 * n div 3"), F.col("_most"))
    least = F.greatest(F.lit(1), F.ceil(F.greatest(F.col("u") + low, 2 * F.col("u") - 2 * most) / 14))
    placed = placed.withColumn("_p", (F.size("diff") - least + 1).cast("int")).filter("_p > 0")
    keys = placed.select("grp", "id", "comp", F.explode(F.expr("slice(diff, 1, _p)")).alias("e")).select(
        F.xxhash64("grp", "e").alias("key"), "grp", "id", "comp")
    keys = materialise(links.spark, keys, "prefixes")
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                      F.min(F.struct("id", "comp")).alias("first"))
    buckets = buckets.filter("lo < hi").select("key", "n", F.col("first.id").alias("leader"),
                                               F.col("first.comp").alias("leader_comp"))
    return materialise(links.spark, keys.join(buckets, "key"), "buckets")


def _by_differences(links: _Links, still: DataFrame) -> None:
    """Add every link between members of mixed buckets (``key, id``) that are not yet in one component."""
    wanted = _groups(links, still)
    parts = _mixed_buckets(links, _divided(links, wanted.select(F.col("grp").alias("key"), "id"), 1))
    diffs = _group_differences(links, wanted)
    nearest = diffs.groupBy("grp").agg(F.min(F.struct("u", "id")).alias("_m"))
    certain = diffs.join(nearest, "grp").filter((F.col("u") + F.col("_m.u") <= 0) & (F.col("id") != F.col("_m.id"))).select(
        F.least("id", "_m.id").alias("a"), F.greatest("id", "_m.id").alias("b"))
    links.verify(_candidates(parts), certain)
    mixed = _prefix_buckets(links, diffs)
    links.verify(_candidates(mixed))
    large = mixed.filter(F.col("n") > SMALL_BUCKET).select("key", "grp", "id")
    grp = large.groupBy("key").agg(F.min("grp").alias("grp"))
    held = _mixed_buckets(links, large.select("key", "id")).select("key", "id", "comp").join(grp, "key")
    held = materialise(links.spark, held.distinct().join(diffs, ["grp", "id"]).drop("grp", "n"), "blocks")
    if not held.isEmpty():
        links.add(_dealt(held, "size(diff)").groupBy("key", "block", "span").applyInPandas(
            _block_links, "a long, b long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    plan: Banding = Banding()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; see the module's text."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialise(spark, docs.mapInArrow(_signer(plan), _SIGNED), "signatures")
    linked = rows.filter("doc_id is not null and n_shingles > 0")
    # Equal sets are one class.  The first row of each set, smallest doc_id first.
    signed = materialise(spark, linked.groupBy("set_hash").agg(
        F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r")).select(
        F.col("r.doc_id").alias("id"), F.col("r.n_shingles").alias("n"), F.col("r.sig").alias("sig"), "set_hash"), "classes")
    links = _Links(spark, signed, docs.filter("doc_id is not null"), plan)
    # A doc_id with several different texts is one document: its classes are linked.
    several = materialise(spark, linked.groupBy("doc_id").agg(F.min("set_hash").alias("x"), F.max("set_hash").alias("y"))
                          .filter("x <> y").select("doc_id"), "repeated-ids")
    if not several.isEmpty():
        own = linked.join(several, "doc_id").select("doc_id", "set_hash").join(signed.select("id", "set_hash"), "set_hash")
        links.add(own.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    mixed = _mixed_buckets(links, _bands(signed, plan))
    links.verify(_candidates(mixed))
    still = materialise(spark, _still_mixed(links, mixed), "buckets")
    if not still.isEmpty():
        _by_differences(links, still)
    classes = links.with_component(signed.select("id", "set_hash"), "id", "component")
    out = rows.select("doc_id", "n_shingles", "set_hash").join(
        classes.select("set_hash", "component"), "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "doc_id")) \
        .otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_dedup(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each group of near copies."""
    gone = near_duplicates(spark, docs, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = materialise(spark, gone, "removed")
    return docs.join(gone, docs[doc_id] == F.col("_gone"), "left_anti")
