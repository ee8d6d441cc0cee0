"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a pre-token the table keeps the one token that can end its encoding. A token t that
ends at i and starts at j is that token exactly if (last[j], t) is a pair that merging leaves apart. An automaton
over the tokens names those that end at i, longest first, so that only they are tried. The table of a prefix does
not depend on what follows, so appends go on from the stored row and an edit is re-encoded from the first row
that it touches.

Nulls: a null text is the empty text, no tokens. Very long texts: the work is in proportion to the text, and a
text's ids are held once. Ties: none, an encoding is unique. Empty tables give empty tables; repeated rows are
encoded each for itself; columns other than the text (and the key of the queries) are left alone. doc_id is an
integer in the queries; encode_texts takes a key of any type.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_rows

#: Distinct pre-tokens in each of the two generations that one Python worker remembers.
CACHED = 250_000
#: Judged pairs of tokens, and steps of the automaton beyond its tree, that one Python worker remembers.
REMEMBERED = 1_000_000


class Generations(dict):
    """A bounded memory of make(key): the newest `most` keys, and those of the generation before until they are met again."""

    def __init__(self, make, most: int = CACHED):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Suffixes:
    """Automaton over the tokens: after each byte, the tokens that end there."""

    def __init__(self, ranks: dict[bytes, int]):
        self.steps: list[dict[int, int]] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for token, rank in ranks.items():
            at = 0
            for b in token:
                nxt = self.steps[at].get(b)
                if nxt is None:
                    nxt = self.steps[at][b] = len(self.steps)
                    self.steps.append({})
                    own.append(None)
                at = nxt
            own[at] = (rank, len(token))
        self.fail = [0] * len(self.steps)
        #: Of each state: (token, length) of the tokens that are suffixes of what it has read, longest first.
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.steps)
        level = [0]
        tree = [dict(s) for s in self.steps]
        while level:
            below = []
            for at in level:
                for b, nxt in tree[at].items():
                    back = self.fail[at]
                    while back and b not in tree[back]:
                        back = self.fail[back]
                    self.fail[nxt] = tree[back].get(b, 0) if at else 0
                    more = self.ends[self.fail[nxt]]
                    self.ends[nxt] = (own[nxt], *more) if own[nxt] else more
                    below.append(nxt)
            level = below
        self.added = 0

    def step(self, state: int, byte: int) -> int:
        """The state after a byte that the tree does not lead on with; remembered, up to a bound, as a step of its own."""
        back = state
        while back and byte not in self.steps[back]:
            back = self.fail[back]
        found = self.steps[back].get(byte, 0)
        if self.added < REMEMBERED:
            self.added += 1
            self.steps[state][byte] = found
        return found


class PrefixBPE:
    """ranks: bytes of each token -> id, ids in the order of the merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.suffixes = Suffixes(ranks)
        self._apart: dict[int, bool] = {}
        self._spines: tuple[dict, dict] = ({}, {})

    def apart(self, a: int, b: int) -> bool:
        """Whether a, b stay as they are when the bytes of both are merged from scratch.

        While the two grow, what touches at the border is some end piece of a and some beginning of b. They join
        if the two together are a token whose merge comes before the merges that take either of them up; of
        equal merges the left one comes first.
        """
        get = self.ranks.get
        for x, taken_x in self._spine(a, 1):
            for y, taken_y in self._spine(b, 0):
                r = get(x + y)
                if r is not None and r < taken_x and r <= taken_y:
                    return False
        return True

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The token, its last merge's left (0) or right (1) part, that part's part, ...: bytes, and the merge that takes it up."""
        found = self._spines[side].get(token)
        if found is None:
            found, t, taken = [], token, len(self.ranks) + 1
            while True:
                piece = self.token[t]
                found.append((piece, taken))
                if len(piece) == 1:
                    break
                taken, t = t, self._merge(piece, t)[-side]
            self._spines[side][token] = found
        return found

    def _merge(self, piece: bytes, before: int) -> list[int]:
        """Plain merging by the merges that come before the given one."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and r < before and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def extend(self, piece: bytes, last: list[int], start: list[int]) -> None:
        """Append the rows of the prefixes that the table (last, start) does not have yet."""
        known, auto = self._apart, self.suffixes
        steps, ends, state = auto.steps, auto.ends, 0
        if len(known) > REMEMBERED:
            known.clear()
        done = len(last)
        for b in piece[max(0, done - self.longest) : done]:
            nxt = steps[state].get(b)
            state = auto.step(state, b) if nxt is None else nxt
        for i in range(done, len(piece)):
            b = piece[i]
            nxt = steps[state].get(b)
            state = auto.step(state, b) if nxt is None else nxt
            for t, size in ends[state]:
                j = i + 1 - size
                if j:
                    pair = last[j - 1] << 32 | t
                    ok = known.get(pair)
                    if ok is None:
                        ok = known[pair] = self.apart(last[j - 1], t)
                    if not ok:
                        continue
                last.append(t)
                start.append(j)
                break
            else:
                raise ValueError("the vocabulary lacks single bytes")

    def read(self, last: list[int], start: list[int]) -> list[int]:
        out, i = [], len(last)
        while i:
            out.append(last[i - 1])
            i = start[i - 1]
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        start: list[int] = []
        self.extend(piece, last, start)
        return self.read(last, start)

    def edit(self, piece: bytes, last: list[int], start: list[int], at: int) -> tuple[list[int], list[int]]:
        """The table of a piece whose bytes before `at` are those of the given table."""
        last, start = last[:at], start[:at]
        self.extend(piece, last, start)
        return last, start

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(4)
def load(path: str) -> PrefixBPE:
    with open(path, "rb") as f:
        return PrefixBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Encoder:
    """Pre-tokens of a text to ids, with a bounded memory of distinct pre-tokens."""

    def __init__(self, path: str, pattern: str):
        self.bpe, self.find = load(path), regex.compile(pattern).findall
        encode = self.bpe.encode
        #: Pre-token -> its ids as 32-bit numbers.
        self.known = Generations(lambda piece: np.array(encode(piece.encode()), "<u4").tobytes())

    def ids(self, pieces: list[str]) -> list[int]:
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<u4").tolist()

    def encode(self, text: str) -> list[int]:
        return self.ids(self.find(text))

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        return [len(x) >> 2 for x in map(self.known.__getitem__, pieces)]


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    """One a worker process: what it has learnt of the words stays for the next tasks."""
    return Encoder(path, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_texts(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """key, ids array<int> of every row."""
    schema = pa.schema([(key, _arrow_type(df, key)), ("ids", pa.list_(pa.int32()))])

    def make():
        enc = encoder(path, pattern)
        return lambda c: {key: c[key], "ids": [enc.encode(t or "") for t in c[text]]}

    return map_rows(df.select(key, text), make, schema)


def decode_ids(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """key, text binary of every row; null ids give empty bytes."""
    schema = pa.schema([(key, _arrow_type(df, key)), ("text", pa.binary())])

    def make():
        bpe = load(path)
        return lambda c: {key: c[key], "text": [bpe.decode(i or []) for i in c[ids]]}

    return map_rows(df.select(key, ids), make, schema)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def digest_texts(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_pretokens: encode, decode what came out, and digest both."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_pretokens", pa.int64())])

    def make():
        enc, sha = encoder(path, pattern), hashlib.sha256
        names = {i: str(i) for i in enc.bpe.token}

        def step(c):
            out = {f.name: [] for f in schema}
            for t in c["text"]:
                pieces = enc.find(t or "")
                ids = enc.ids(pieces)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(sha(enc.bpe.decode(ids)).hexdigest())
                out["n_pretokens"].append(len(pieces))
            return out | {"doc_id": c["doc_id"]}

        return step

    return map_rows(df.select("doc_id", "text"), make, schema)
