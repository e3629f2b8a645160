"""Token counts that follow edits: a segment tree of pre-tokens for each document.

A document's leaves are its pre-tokens in order, each with its length and its
number of tokens; inner nodes hold both sums.  An edit (begin, removed, inserted;
in code points) goes down the sums to the pre-tokens it touches.  Splitting
starts again two pre-tokens before these, as the pattern looks ahead, and ends as soon as a new boundary beyond the edit falls on an old one:
from there on the pattern, which never looks back, gives the same pre-tokens.
Only the pre-tokens between are encoded anew; changed leaves take their sums up
to the root.  Where more pre-tokens come in than went out, one leaf holds
several of them; a tree that grows by more than its own size is built anew.

Counts equal those of encoding the edited text from the start.

Cases: a null text is an empty one; a null or empty list of edits changes
nothing; edits apply in order, each to the text as the one before left it, and
one beyond the end is clipped to it; null doc_ids and repeated rows each give a
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEPT_PRETOKENS = 500_000
KEPT_LENGTH = 64


class TokenCounter:
    """Splits text into pre-tokens and counts the tokens of each."""

    def __init__(self, vocabulary: bytes, pattern: str):
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in vocabulary.splitlines() if line)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def tokens(self, pretoken: str) -> int:
        n = self.known.get(pretoken)
        if n is None:
            n = len(self.encoding.encode_ordinary(pretoken))
            if len(pretoken) <= KEPT_LENGTH:
                if len(self.known) >= KEPT_PRETOKENS:
                    self.known.clear()
                self.known[pretoken] = n
        return n


class CountTree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, text: str, counter: TokenCounter):
        self.counter = counter
        self.encoded = 0  # characters encoded by edits
        self._build(text, [(len(p), counter.tokens(p)) for p in counter.pattern.findall(text)])

    def _build(self, text: str, pretokens: list[tuple[int, int]]) -> None:
        self.text = text
        self.leaves = [[p] for p in pretokens]  # pre-tokens held by each leaf
        self.size = 1 << max(0, len(pretokens) - 1).bit_length()
        self.room = 2 * len(pretokens) + 16
        self.held = len(pretokens)
        sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        if pretokens:
            sums[self.size:self.size + len(pretokens)] = pretokens
        width = self.size
        while width > 1:
            sums[width // 2:width] = sums[width:2 * width].reshape(-1, 2, 2).sum(axis=1)
            width //= 2
        self.chars, self.counts = sums[:, 0].tolist(), sums[:, 1].tolist()

    @property
    def n_tokens(self) -> int:
        return self.counts[1]

    def _find(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) that holds character ``place``; the last one for the text's end."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def _set(self, leaf: int, pretokens: list[tuple[int, int]]) -> None:
        self.held += len(pretokens) - len(self.leaves[leaf])
        self.leaves[leaf] = pretokens
        node = self.size + leaf
        self.chars[node] = sum(c for c, _ in pretokens)
        self.counts[node] = sum(t for _, t in pretokens)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.counts[node] = self.counts[2 * node] + self.counts[2 * node + 1]

    def edit(self, begin: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` code points at ``begin`` by ``inserted``."""
        begin = min(max(begin, 0), len(self.text))
        end = min(begin + max(removed, 0), len(self.text))
        new = self.text[:begin] + inserted + self.text[end:]
        if not self.leaves:
            self._build(new, [(len(p), self.counter.tokens(p)) for p in self.counter.pattern.findall(new)])
            self.encoded += len(new)
            return
        leaf, start = self._find(max(begin - 1, 0))
        for _ in range(2):  # context: a match looks at most two characters beyond its end
            if start:
                leaf, start = self._find(start - 1)
        shift = len(inserted) - (end - begin)
        done, at, last, old_end, pretokens = None, start, leaf, start + self.chars[self.size + leaf], []
        boundary = {start + x for x in np.cumsum([c for c, _ in self.leaves[leaf]]).tolist()}
        for match in self.counter.pattern.finditer(new, start):
            pretokens.append((match.end() - match.start(), self.counter.tokens(match.group())))
            at = match.end()
            if at < begin + len(inserted):
                continue
            old = at - shift  # the same place in the old text, beyond the edit
            while old_end < old and last + 1 < len(self.leaves):
                last += 1
                boundary.update((old_end + np.cumsum([c for c, _ in self.leaves[last]])).tolist())
                old_end += self.chars[self.size + last]
            if old >= end and old in boundary:
                done = old
                break
        self.encoded += at - start
        if done is None:  # the end of the text was reached
            last = len(self.leaves) - 1
        elif done < old_end:  # a leaf with several pre-tokens keeps those after the boundary
            rest, place = [], old_end - self.chars[self.size + last]
            for c, t in self.leaves[last]:
                if place >= done:
                    rest.append((c, t))
                place += c
            pretokens += rest
        self.text = new
        slots = last - leaf + 1
        for k in range(slots - 1):
            self._set(leaf + k, pretokens[k:k + 1])
        self._set(last, pretokens[slots - 1:])
        if self.held > self.room:
            self._build(new, [p for own in self.leaves for p in own])


def count_with_edits(spark: SparkSession, docs: DataFrame, edits: Column, vocabulary: str, pattern: str,
                     doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token counts before and after each document's edits.

    ``edits``: array<struct<begin long, removed long, inserted string>> of the row.
    Columns: doc_id, n_tokens, n_edits, edited_tokens, edited_chars, encoded_chars
    (characters that the edits had encoded again).
    """
    with open(vocabulary, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())  # one vocabulary

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(raw.value, pattern)
        for batch in batches:
            out = []
            for t, changes in zip(batch.column("_text"), batch.column("_edits")):
                tree = CountTree(t.as_py(), counter)
                before, listed = tree.n_tokens, changes.as_py() or []
                for e in listed:
                    tree.edit(e["begin"] or 0, e["removed"] or 0, e["inserted"] or "")
                out.append((before, len(listed), tree.n_tokens, len(tree.text), tree.encoded))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[i] for r in out], pa.int64()) for i in range(5)]],
                ["doc_id", "n_tokens", "n_edits", "edited_tokens", "edited_chars", "encoded_chars"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                       edits.alias("_edits")).mapInArrow(
        rows, "doc_id long, n_tokens long, n_edits long, edited_tokens long, edited_chars long, encoded_chars long")


def sample_edits(text: str = "text") -> Column:
    """Three edits made from the text itself: cut at a quarter, insert in the middle, append at the end."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t).cast("long")

    def one(begin: Column, removed: int, inserted: Column) -> Column:
        return F.struct(begin.cast("long").alias("begin"), F.lit(removed).cast("long").alias("removed"),
                        inserted.alias("inserted"))

    return F.array(one(F.floor(n / 4), 16, F.lit("")), one(F.floor(n / 2), 0, F.substring(t, 1, 16)),
                   one(n, 0, F.right(t, F.lit(16))))
