"""Edit-aware token counts: a segment tree over each document's pre-tokens, kept as a table between edits.

A leaf holds one pre-token's length (in code points) and its number of tokens. Blocks of leaves keep their piece of
the text, inner nodes the sums below them. An edit goes down to the last pre-token that it cannot have changed,
re-reads the text from there until the new cuts fall on old ones again, and replaces only those leaves; only their
ancestors' sums change, so an edit costs the height of the tree and the region that it touches.

The stored form of a tree is a row: doc_id, text, lengths, counts. build_trees makes it, edit_trees takes it (nothing
is encoded but the touched region) and gives back the edited one.

Nulls: a null text is the empty text (0 tokens), a null replacement the empty one, a null bound 0; null lengths or
counts are an empty tree. Edit bounds outside the text are clamped. Very long texts: blocks stay small, so one edit of
a long text touches few of them. Ties: none. Text between a pattern's matches is a leaf of no tokens. Empty tables
give empty tables, repeated rows are counted each for itself. doc_id is an integer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bpe import encoder
from .common import map_rows

#: A pre-token is settled once this many code points after it are known: one that the pattern looks ahead to, one it backs off from.
LOOKAHEAD = 2
#: Leaves of a block and children of a node, when the tree is built; twice as many are split.
FAN = 64
#: Code points behind an edit that are read first; four times as many each time they are not enough.
WINDOW = 64


class Block:
    """Up to 2 FAN leaves in order, and their text."""

    __slots__ = ("text", "lengths", "counts", "leaves", "chars", "tokens")

    def __init__(self, text: str, lengths: list[int], counts: list[int]):
        self.text, self.lengths, self.counts = text, lengths, counts
        self.leaves, self.chars, self.tokens = len(lengths), len(text), sum(counts)

    def find(self, chars: int) -> tuple[int, int]:
        leaves = done = 0
        for n in self.lengths:
            if done + n > chars:
                break
            leaves, done = leaves + 1, done + n
        return leaves, done

    def read(self, lo: int, hi: int) -> Iterator[str]:
        yield self.text[lo:hi]

    def blocks(self) -> Iterator[Block]:
        yield self

    def splice(self, lo: int, hi: int, new: Block) -> list[Block]:
        """The blocks that stand for this one with leaves lo to hi replaced by those of new."""
        a, b = sum(self.lengths[:lo]), sum(self.lengths[:hi])
        text = self.text[:a] + new.text + self.text[b:]
        return grouped(text, self.lengths[:lo] + new.lengths + self.lengths[hi:], self.counts[:lo] + new.counts + self.counts[hi:])


class Node:
    """Up to 2 FAN blocks or nodes, and the sums over them."""

    __slots__ = ("below", "leaves", "chars", "tokens")

    def __init__(self, below: list):
        self.below = below
        self.leaves, self.chars, self.tokens = (sum(getattr(x, k) for x in below) for k in ("leaves", "chars", "tokens"))

    def find(self, chars: int) -> tuple[int, int]:
        """How many leaves from the left end within so many code points, and where the last of them ends."""
        leaves = done = 0
        for x in self.below:
            if done + x.chars > chars:
                a, b = x.find(chars - done)
                return leaves + a, done + b
            leaves, done = leaves + x.leaves, done + x.chars
        return leaves, done

    def read(self, lo: int, hi: int) -> Iterator[str]:
        at = 0
        for x in self.below:
            if at < hi and at + x.chars > lo:
                yield from x.read(max(0, lo - at), hi - at)
            at += x.chars

    def blocks(self) -> Iterator[Block]:
        for x in self.below:
            yield from x.blocks()

    def splice(self, lo: int, hi: int, new: Block) -> list[Node]:
        at, below, placed = 0, [], False
        for k, x in enumerate(self.below):
            a, b = lo - at, hi - at
            at += x.leaves
            if b < 0 or a > x.leaves or (placed and b <= 0) or (not placed and a == x.leaves and k + 1 < len(self.below)):
                below.append(x)
                continue
            a, b = max(0, a), min(b, x.leaves)
            if placed and b == x.leaves:
                continue
            below += x.splice(a, b, EMPTY if placed else new)
            placed = True
        if not below:
            return []
        return [Node(below)] if len(below) <= 2 * FAN else [Node(below[i : i + FAN]) for i in range(0, len(below), FAN)]


EMPTY = Block("", [], [])


def grouped(text: str, lengths: list[int], counts: list[int]) -> list[Block]:
    if len(lengths) <= 2 * FAN:
        return [Block(text, lengths, counts)] if lengths else []
    out, at = [], 0
    for i in range(0, len(lengths), FAN):
        part = lengths[i : i + FAN]
        end = at + sum(part)
        out.append(Block(text[at:end], part, counts[i : i + FAN]))
        at = end
    return out


class CountedText:
    """The tree of one text; count: pre-tokens -> the tokens of each."""

    def __init__(self, text: str, count: Callable[[list[str]], list[int]], pattern, lengths: list[int] | None = None, counts: list[int] | None = None):
        """lengths, counts: the leaves, where they are known already; nothing is encoded then."""
        self.count, self.pattern = count, pattern
        if lengths is None or counts is None:
            lengths, counts = self.leaves_of(text)
        self.root = self._root(grouped(text, lengths, counts))

    def leaves_of(self, text: str) -> tuple[list[int], list[int]]:
        if not self.pattern.groups:
            pieces = self.pattern.findall(text)
            lengths = list(map(len, pieces))
            if sum(lengths) == len(text):
                return lengths, self.count(pieces)
        found = list(self.scan(text))
        held = iter(self.count([text[at : at + n] for at, n, match in found if match]))
        return [n for _, n, _ in found], [next(held) if match else 0 for _, _, match in found]

    def scan(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """start, length, whether it is a match: of the matches and of what stands between them."""
        at = 0
        for m in self.pattern.finditer(text):
            if m.start() > at:
                yield at, m.start() - at, False
            if m.end() > m.start():
                yield m.start(), m.end() - m.start(), True
            at = m.end()
        if at < len(text):
            yield at, len(text) - at, False

    @staticmethod
    def _root(nodes: list) -> Block | Node:
        while len(nodes) > 1:
            nodes = [Node(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        return nodes[0] if nodes else EMPTY

    @property
    def n_tokens(self) -> int:
        return self.root.tokens

    @property
    def n_chars(self) -> int:
        return self.root.chars

    @property
    def n_pretokens(self) -> int:
        return self.root.leaves

    @property
    def text(self) -> str:
        return "".join(b.text for b in self.root.blocks())

    @property
    def lengths(self) -> list[int]:
        return [n for b in self.root.blocks() for n in b.lengths]

    @property
    def counts(self) -> list[int]:
        return [n for b in self.root.blocks() for n in b.counts]

    @property
    def ends(self) -> list[int]:
        return list(accumulate(self.lengths))

    def edit(self, lo: int, hi: int, new: str) -> int:
        """Replace code points lo to hi by new; returns the number of pre-tokens that were encoded again."""
        root, n = self.root, self.root.chars
        lo = min(max(0, lo), n)
        hi = min(max(lo, hi), n)
        first, at = root.find(max(0, lo - LOOKAHEAD))
        head, more = "".join(root.read(at, lo)) + new, WINDOW
        while True:
            end = min(n, hi + more)
            window = head + "".join(root.read(hi, end))
            settled = len(window) if end == n else len(window) - LOOKAHEAD
            pieces, old = [], None
            for start, size, match in self.scan(window):
                stop = start + size
                if stop > settled or (not match and end < n):
                    break
                pieces.append((start, size, match))
                if stop >= len(head):
                    back = hi + stop - len(head)
                    leaves, chars = root.find(back)
                    if chars == back:
                        old = leaves
                        break
            else:
                old = root.leaves if end == n else None
            if old is not None:
                break
            more *= 4
        held = iter(self.count([window[s : s + k] for s, k, match in pieces if match]))
        stop = pieces[-1][0] + pieces[-1][1] if pieces else 0
        fresh = Block(window[:stop], [k for _, k, _ in pieces], [next(held) if match else 0 for _, _, match in pieces])
        self.root = self._root(root.splice(first, old, fresh))
        while isinstance(self.root, Node) and len(self.root.below) == 1:
            self.root = self.root.below[0]
        return len(pieces)


@lru_cache(2)
def compiled(pattern: str):
    return regex.compile(pattern)


TREE = [("text", pa.string()), ("lengths", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]


def build_trees(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """From doc_id, text the stored trees: doc_id, text, lengths, counts (one entry a pre-token)."""
    schema = pa.schema([("doc_id", pa.int64()), *TREE])

    def make():
        enc, pat = encoder(path, pattern), compiled(pattern)
        tree = CountedText("", enc.counts, pat)

        def step(c):
            texts = [t or "" for t in c["text"]]
            leaves = [tree.leaves_of(t) for t in texts]
            return {"doc_id": c["doc_id"], "text": texts, "lengths": [x for x, _ in leaves], "counts": [x for _, x in leaves]}

        return step

    return map_rows(df.select("doc_id", "text"), make, schema)


def edit_trees(df: DataFrame, path: str, pattern: str, trees: bool = True) -> DataFrame:
    """From stored trees with lo, hi, new: sizes before and after the edit, n_reencoded, and (with trees) the edited tree.

    lo, hi: code points that `new` replaces.
    """
    names = ("n_chars", "n_pretokens", "n_tokens", "edited_n_chars", "edited_n_pretokens", "edited_n_tokens", "n_reencoded")
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), *(TREE if trees else [])])

    def make():
        enc, pat = encoder(path, pattern), compiled(pattern)

        def step(c):
            out = {f.name: [] for f in schema}
            for text, lengths, counts, lo, hi, new in zip(c["text"], c["lengths"], c["counts"], c["lo"], c["hi"], c["new"], strict=True):
                t = CountedText(text or "", enc.counts, pat, lengths or [], counts or [])
                before = (t.n_chars, t.n_pretokens, t.n_tokens)
                again = t.edit(lo or 0, hi or 0, new or "")
                for n, v in zip(names, (*before, t.n_chars, t.n_pretokens, t.n_tokens, again), strict=True):
                    out[n].append(v)
                for n, _ in TREE if trees else []:
                    out[n].append(getattr(t, n))
            return out | {"doc_id": c["doc_id"]}

        return step

    return map_rows(df.select("doc_id", *(n for n, _ in TREE), "lo", "hi", "new"), make, schema)
