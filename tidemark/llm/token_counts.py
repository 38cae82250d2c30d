"""Token counts that follow edits.

A document is cut into pre-tokens by the tokenizer's pattern. Runs of pre-tokens are the leaves of a segment tree whose
nodes hold sums of characters and of tokens. An edit finds its leaves by descending over the characters, and re-encodes
only the edited region with boundary context: matching starts anew at the pre-token that touches the edit's start, since a
match depends on its own characters and at most two beyond, and goes on until a pre-token ends where an old one began
behind the edit; from there on nothing can change. The sums on the paths above the touched leaves are then updated, and
leaves that grew long are split.

Trees are kept between runs as a table: each document's text with the lengths and token counts of its pre-tokens. A run
that edits documents reads its trees from there, encodes nothing but the edited regions, and returns the new trees.

Defined cases: a null text counts as empty, null edits as none, and a null edit in a list is skipped; edits apply one after
another, each to the text that the one before left; positions are code points and are clamped to the text; a null
replacement deletes; an edit in an empty document inserts; repeated rows are counted alike; other columns pass through, one
with an output's name as `<name>_input`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import MEMO, ByteBpe, pattern_for
from tidemark.llm.common import blocks, kept, set_aside, written

#: Pre-tokens of a leaf.
LEAF = 64
TREE = ("lengths", "counts", "n_tokens")
EDITED = ("n_edits", "n_chars_encoded", "n_tokens_edited", "n_chars_edited")


class _Counter:
    """Tokens of a pre-token, with a bounded memo."""

    def __init__(self, path: str) -> None:
        self.coder = ByteBpe(path)
        self.memo: dict[str, int] = {}

    def __call__(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            n = len(self.coder.encode_piece(piece.encode()))
            if len(piece) < 64:
                self.memo[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> _Counter:
    return _Counter(path)


class TokenTree:
    """Segment tree over the pre-tokens of one document. `tokens` is the whole count, `encoded` the characters encoded so far by edits."""

    def __init__(self, text: str, lengths: list[int], counts: list[int], count: _Counter) -> None:
        """From the text and its pre-tokens' lengths and token counts; nothing is encoded."""
        self.count, self.encoded = count, 0
        self.leaves: list[tuple[str, list[int], list[int]]] = []
        at = 0
        for i in range(0, len(lengths), LEAF):
            own = lengths[i : i + LEAF]
            end = at + sum(own)
            self.leaves.append((text[at:end], own, counts[i : i + LEAF]))
            at = end
        self._index()

    @classmethod
    def build(cls, text: str, count: _Counter) -> TokenTree:
        pieces = pattern_for(text).findall(text)
        return cls(text, list(map(len, pieces)), list(map(count, pieces)), count)

    def state(self) -> tuple[str, list[int], list[int]]:
        return "".join(x[0] for x in self.leaves), [n for x in self.leaves for n in x[1]], [n for x in self.leaves for n in x[2]]

    def _index(self) -> None:
        self.leaves = self.leaves or [("", [], [])]
        self.size = 1
        while self.size < len(self.leaves):
            self.size *= 2
        empty = [0] * (self.size - len(self.leaves))
        self.chars = [0] * self.size + [len(x[0]) for x in self.leaves] + empty
        self.sums = [0] * self.size + [sum(x[2]) for x in self.leaves] + empty
        for i in range(self.size - 1, 0, -1):
            self._pull(i)

    def _pull(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds character `at` (the last used one for the end of the text), and the character at which it starts."""
        i, start = 1, 0
        if at >= self.chars[1]:
            at = max(0, self.chars[1] - 1)
        while i < self.size:
            i *= 2
            if at >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), start

    def _pieces(self, leaf: int) -> list[tuple[str, int]]:
        text, lengths, counts = self.leaves[leaf]
        at, out = 0, []
        for n, c in zip(lengths, counts, strict=True):
            out.append((text[at : at + n], c))
            at += n
        return out

    def _replace(self, first: int, last: int, pieces: list[tuple[str, int]]) -> None:
        """Put pieces in the place of leaves first to last; if they are too many for them, leaves split and the sums are indexed anew."""
        n = last - first + 1
        split = len(pieces) > 2 * LEAF * n
        share = LEAF if split else -(-len(pieces) // n)
        parts = [pieces[k : k + share] for k in range(0, len(pieces), share)] if pieces else []
        new = [("".join(x for x, _ in p), [len(x) for x, _ in p], [c for _, c in p]) for p in parts]
        self.leaves[first : last + 1] = new if split else new + [("", [], [])] * (n - len(new))
        if split:
            self._index()
            return
        for i in range(first, last + 1):
            self.chars[self.size + i], self.sums[self.size + i] = len(self.leaves[i][0]), sum(self.leaves[i][2])
        low, high = self.size + first, self.size + last
        while low > 1:
            low //= 2
            high //= 2
            for i in range(low, high + 1):
                self._pull(i)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters [start, end) by new."""
        start = min(max(0, start), self.length)
        end = min(max(start, end), self.length)
        if start == end and not new:
            return
        # The first pre-token that the edit can change: white space looks two characters beyond its end.
        first, base = self._find(max(0, start - 2))
        pieces = self._pieces(first)
        keep, at = 0, base
        while keep < len(pieces) and at + len(pieces[keep][0]) < start - 1:
            at += len(pieces[keep][0])
            keep += 1
        last, shift = first, len(new) - (end - start)
        region = pieces[keep:]
        stop = at + sum(len(x) for x, _ in region)  # end of the old text in the region
        while True:
            while stop < end and last + 1 < len(self.leaves):
                last += 1
                region += self._pieces(last)
                stop += self.chars[self.size + last]
            old = "".join(x for x, _ in region)
            text = old[: start - at] + new + old[end - at :]
            more = last + 1 < len(self.leaves)
            joints, p = {}, at
            for k, (x, _) in enumerate(region):  # old boundaries behind the edit, as positions in the new text
                if p >= end:
                    joints.setdefault(p - at + shift, k)
                p += len(x)
            fresh: list[str] = []
            tail = None
            for m in pattern_for(text).finditer(text):
                a, b = m.span()
                if a in joints and a >= start - at + len(new):
                    tail = region[joints[a] :]
                    break
                if more and b >= len(text) - 1:
                    break  # what follows the region could lengthen this match
                fresh.append(m.group())
            else:
                if not more:
                    tail = []
            if tail is not None:
                break
            last += 1
            region = region + self._pieces(last)
            stop += self.chars[self.size + last]
        self.encoded += sum(map(len, fresh))
        self._replace(first, last, pieces[:keep] + [(x, self.count(x)) for x in fresh] + tail)


def token_trees(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """docs with each document's tree: pre-token lengths and token counts (little-endian unsigned 32-bit), and n_tokens. Null text becomes empty."""
    docs = set_aside(docs, *TREE)
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest, text).schema.add("lengths", "binary").add("counts", "binary").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks_path)
        for batch, texts in blocks(batches, text):
            lengths, counts, totals = [], [], []
            for x in texts:
                pieces = pattern_for(x).findall(x)
                found = list(map(count, pieces))
                lengths.append(np.array(list(map(len, pieces)), "<u4").tobytes())
                counts.append(np.array(found, "<u4").tobytes())
                totals.append(sum(found))
            yield pa.RecordBatch.from_arrays([*kept(batch, rest), pa.array(texts, pa.string()), pa.array(lengths, pa.binary()), pa.array(counts, pa.binary()), pa.array(totals, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def edit_trees(trees: DataFrame, ranks_path: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """The trees after their edits, with n_edits, n_chars_encoded, n_tokens_edited and n_chars_edited; n_tokens stays the count before.

    `edits` is array<struct<start: int or long, end: int or long, replacement: string>>; it is left out of the result.
    """
    trees = set_aside(trees, *EDITED)
    rest = [c for c in trees.columns if c not in (text, edits, "lengths", "counts")]
    schema = trees.select(*rest, text, "lengths", "counts").schema
    for n in EDITED:
        schema = schema.add(n, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks_path)
        for batch, texts in blocks(batches, text):
            states, numbers = [], []
            for x, lengths, counts, changes in zip(texts, *(c.to_pylist() for c in kept(batch, ["lengths", "counts", edits])), strict=True):
                tree = TokenTree(x, np.frombuffer(lengths, "<u4").tolist(), np.frombuffer(counts, "<u4").tolist(), count)
                done = [tree.edit(c["start"] or 0, c["end"] or 0, c["replacement"] or "") for c in changes or [] if c is not None]
                numbers.append((len(done), tree.encoded, tree.tokens, tree.length))
                new, lengths, counts = tree.state()
                states.append((new, np.array(lengths, "<u4").tobytes(), np.array(counts, "<u4").tobytes()))
            columns = [pa.array([s[k] for s in states], kind) for k, kind in enumerate((pa.string(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*kept(batch, rest), *columns, *(pa.array([r[k] for r in numbers], pa.int64()) for k in range(len(EDITED)))], names=schema.names)

    return trees.mapInArrow(run, schema)


def review_edits(text):
    """The production edit script, drawn from each text by hashing it: a deletion, an insertion, a replacement and a note at the end."""
    n = F.char_length(F.coalesce(text, F.lit("")))
    at = lambda salt: F.when(n > 0, F.pmod(F.xxhash64(text, F.lit(salt)), n)).otherwise(0).cast("long")

    def change(start, size: int, new: str):
        return F.struct(start.alias("start"), (start + size).alias("end"), F.lit(new).alias("replacement"))

    return F.array(change(at(1), 40, ""), change(at(2), 0, " (reviewed)"), change(at(3), 12, "redacted 2024"), change(n.cast("long"), 0, "\nEnd of text."))


def query(spark, sf_dir: str) -> DataFrame:
    """Build and write the trees of all documents, then apply the edits to what was written."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    trees = written(token_trees(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), ranks), "trees", codec="zstd")
    return edit_trees(trees.withColumn("edits", review_edits(F.col("text"))), ranks).select("doc_id", "n_tokens", *EDITED)
