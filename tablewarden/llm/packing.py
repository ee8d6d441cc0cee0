"""Best-fit packing: a configuration linear program over the histogram of piece lengths.

The program: as few configurations (multisets of lengths that fit into a sequence) as cover every length's pieces.
Multiplicative weights price the lengths; a knapsack table over the capacity finds for every length the best
configuration that holds it; those that are worth about the most are used, and what a round covers of a length
lowers its weight. Any prices give a lower bound on the number of sequences, of which the best is kept. The
fractional solution is rounded at several shares of fullness: of configurations that are full enough the whole parts, then
one more of each while its pieces are there; the rest goes by best fit, longest first, into the room that they leave and
into new sequences. The rounding of fewest sequences holds, so the plan is never worse than best fit alone. All of this sees
only the histogram (one count a length, so never more than the capacity); Spark ranks the pieces within their
length and each takes the slot of its rank.

Nulls: a null text is the empty one. Lengths of 0 or less, or null, take no place and are refused. Very long texts
are cut into pieces of the capacity. Empty tables give empty tables; repeated rows are pieces of their own. Ties:
equal ranks are broken by the piece's columns; of equal pieces any may take either slot. doc_id is an integer.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from functools import lru_cache
from itertools import batched
from struct import pack as pack_ids

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, map_rows, scratch

CAPACITY = 2048
#: Rounds of the multiplicative weights; share of a length that one round covers at most; how fast weights fall with it; configurations within SLACK of the best price are used.
ROUNDS, STEP, RATE, SLACK = 40, 0.05, 1.0, 0.5
#: Rounds after those that cover what is left, without covering any length again.
LAST = 12
#: How full, against the fullest, configurations must be that are taken whole. Every share is tried; for the first the program
#: is solved SOLVES times, each time for what rounding left.
FULLS, SOLVES = (0.995, 0.98, 0.95, 0.9, 0.8, 0.0), 4
#: Pieces of one length that one task ranks, about.
RANKED = 20_000
#: Distinct words in each of the two generations whose ids one Python worker keeps.
CACHED = 250_000


# --- pieces ----------------------------------------------------------------------------------------------


class WordIds(dict):
    """White-space separated word -> its ids as little-endian 32-bit bytes; neither the splitting nor the merges of the vocabulary cross white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.old = Tokenizer.from_file(path), {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closing[i] = token.endswith("</w>")

    def learn(self, words: set[str]) -> None:
        """Keep the ids of these words, none of which is kept yet."""
        if len(self) + len(words) > CACHED and len(self):
            self.old = dict(self)
            self.clear()
        for w in words.intersection(self.old):
            self[w] = self.old[w]
        words = words.difference(self)
        # letters alone are one match, whose last id closes it: such words can go to the tokenizer together
        latin = [w for w in words if w.isalpha() and (w.isascii() or max(w) < "\u0100")]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(latin)], add_special_tokens=False)[0].ids, "<u4")
        ends = ((np.flatnonzero(self.closing[ids]) + 1) * 4).tolist() if len(ids) else []
        if len(ends) == len(latin):
            raw, start = ids.tobytes(), 0
            for w, end in zip(latin, ends, strict=True):
                self[w] = raw[start:end]
                start = end
            words = words.difference(latin)
        rest = [*words]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[w] = pack_ids(f"<{len(e.ids)}I", *e.ids)

    def split(self, text: str) -> list[str]:
        """Parts that the tokenizer treats each for itself, in order.

        White space always parts (str.split() takes the separators 1C to 1F for white space, the tokenizer does
        not), but a text that holds an added token stays whole. In texts of Latin-1 letters without apostrophes,
        which may start a match of their own, lower case is one to one and signs part from what is around them.
        """
        if any(x in text for x in SEPARATORS) or any(x in text for x in self.special):
            return [text]
        if "'" in text:
            return text.split()
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split()
        text = text.lower()
        if b".." in raw.translate(SIGN):  # runs of signs are one match
            return LATIN_PARTS(text)
        for sign in set(raw.translate(None, NO_SIGN).decode("latin-1")):
            text = text.replace(sign, f" {sign} ")
        return text.split()

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        words = [w for ws in split for w in ws]
        found = list(map(self.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            new = {words[i] for i in missing}
            for some in batched(new, CACHED):
                self.learn(set(some))
                for i in missing:
                    if found[i] is None:
                        found[i] = self.get(words[i])
        out, at = [], 0
        for ws in split:
            out.append(b"".join(found[at : at + len(ws)]))
            at += len(ws)
        return out


SEPARATORS = "\x1c\x1d\x1e\x1f"
_LATIN = [chr(i) for i in range(256)]
#: Latin-1 without letters, numbers and white space.
NO_SIGN = bytes(i for i, c in enumerate(_LATIN) if c.isalpha() or c.isnumeric() or c.isspace())
SIGN = bytes(97 if i in NO_SIGN else 46 for i in range(256))
# superscript figures and fractions are numbers, not letters
LATIN_PARTS = re.compile(r"[^\W\d_²³¹¼½¾]+|(?:[\d_²³¹¼½¾]|[^\w\s])+").findall


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenize_pieces(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids and a closing 0, cut only where they exceed the capacity."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def make():
        words = word_ids(path)

        def step(c):
            rows = []
            for key, ids in zip(c["doc_id"], words.ids([t or "" for t in c["text"]]), strict=True):
                ids += b"\0\0\0\0"
                for k in range(-(-len(ids) // (4 * capacity))):
                    part = ids[4 * capacity * k : 4 * capacity * (k + 1)]
                    rows.append((key, k, capacity * k, len(part) // 4, zlib.crc32(part)))
            return dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True))

        return step

    return map_rows(df.select("doc_id", "text"), make, schema)


# --- the program over the histogram ------------------------------------------------------------------------


def knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c], choice[c]: greatest value of lengths that sum to c at most, and the length to take first (0: none, -1: leave one place empty). value[l] < 0: absent."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(value >= 0)[::-1]  # of equally good ones the longest
    worth = value[lengths]
    skip = (len(lengths) - np.searchsorted(lengths[::-1], np.arange(capacity + 1), "right")).tolist()
    for c in range(1, capacity + 1):
        k = skip[c]
        best[c] = best[c - 1]
        choice[c] = -1
        if k < len(lengths):
            got = worth[k:] + best[c - lengths[k:]]
            i = int(got.argmax())
            if got[i] > best[c]:
                best[c], choice[c] = got[i], lengths[k + i]
    return best, choice


def configurations(choice: np.ndarray, need: np.ndarray, lengths: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """For every length the best configuration that holds it, longest first; never more of a length than there are."""
    out, steps, there = [], choice.tolist(), need.astype(np.int64).tolist()
    for a in lengths.tolist():
        left, items, held = capacity - a, [a], Counter([a])
        while left > 0:
            t = steps[left]
            if t == 0:
                break
            if t < 0 or held[t] >= there[t]:
                left -= 1
            else:
                items.append(t)
                held[t] += 1
                left -= t
        out.append(tuple(sorted(items, reverse=True)))
    return out


def solve(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional configurations that cover histogram[l] pieces of each length l, and a lower bound on the number of any that do.

    Weights start so that prices are the lengths themselves. A length that is covered is not priced any more.
    """
    need = histogram.astype(float)
    lengths = np.flatnonzero(need[: capacity + 1])
    used: dict[tuple[int, ...], float] = {}
    if not len(lengths):
        return used, 0.0
    cover, bound = np.zeros(capacity + 1), 0.0
    size = np.arange(capacity + 1) / capacity

    def use(items: list[tuple[int, ...]], most: np.ndarray) -> None:
        """One configuration after the other, each until one of its lengths has come to its most."""
        left = most.tolist()
        for c in items:
            held = Counter(c)
            x = min(left[a] / k for a, k in held.items())
            if x > 0:
                used[c] = used.get(c, 0.0) + x
                for a, k in held.items():
                    left[a] -= k * x
        cover[:] += most - left

    for step in [STEP] * ROUNDS + [1.0] * LAST:
        open_ = lengths[cover[lengths] < need[lengths] * (1 - 1e-9)]
        if not len(open_):
            break
        price = np.full(capacity + 1, -1.0)
        price[open_] = size[open_] * np.exp(-RATE * cover[open_] / need[open_])
        best, choice = knapsack(price, capacity)
        worth = price[open_] + best[capacity - open_]
        bound = max(bound, float((need[open_] * price[open_]).sum() / worth.max()))
        near = open_
        if step < 1:  # those that lag behind, near the best price, ask for configurations; the others fill them
            behind = cover[open_] / need[open_] <= (cover * size)[lengths].sum() / (need * size)[lengths].sum() + 1e-9
            near = open_[behind & (worth >= (1 - SLACK) * worth.max())]
        use(configurations(choice, need, near[::-1], capacity), np.minimum(need * step, np.maximum(0, need - cover)) if step == 1 else need * step)
    for a in lengths[cover[lengths] < need[lengths]].tolist():
        k = max(1, min(capacity // a, int(need[a])))
        used[(a,) * k] = used.get((a,) * k, 0.0) + (need[a] - cover[a]) / k
    return used, bound


def fill(rest: np.ndarray, capacity: int, begun: dict[tuple[int, ...], int] | None = None) -> dict[tuple[int, ...], int]:
    """Best fit, longest first, into the begun configurations and new ones. Bins of equal room are filled together: a piece always goes on in the bin that took one of its length."""
    rooms: list[int] = []
    bins: dict[int, dict[tuple[int, ...], int]] = {}

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if room not in bins:
            insort(rooms, room)
            bins[room] = {}
        bins[room][items] = bins[room].get(items, 0) + n

    for items, n in (begun or {}).items():
        put(capacity - sum(items), items, n)
    for a in np.flatnonzero(rest)[::-1].tolist():
        n = int(rest[a])
        while n:
            k = bisect_left(rooms, a)
            if k < len(rooms):
                room = rooms[k]
                items, there = bins[room].popitem()
                if not bins[room]:
                    del bins[room], rooms[k]
            else:
                room, items, there = capacity, (), n
            each = min(n, room // a)
            whole = min(there, n // each)
            put(room - each * a, tuple(sorted((*items, *[a] * each), reverse=True)), whole)
            if items and there > whole:
                put(room, items, there - whole)
            n -= whole * each
    out: dict[tuple[int, ...], int] = {}
    for same in bins.values():
        for items, n in same.items():
            out[items] = out.get(items, 0) + n
    return out


def rounded(histogram: np.ndarray, capacity: int, found: dict[tuple[int, ...], float], share: float, solves: int) -> tuple[dict[tuple[int, ...], int], np.ndarray]:
    """Whole configurations of a fractional solution that are full enough, and the pieces that they leave, which are solved again."""
    rest = histogram.astype(np.int64).copy()
    out: dict[tuple[int, ...], int] = {}

    def take(items: tuple[int, ...], most: int) -> None:
        held = Counter(items)
        n = min(most, *(int(rest[a]) // k for a, k in held.items()))
        if n > 0:
            out[items] = out.get(items, 0) + n
            for a, k in held.items():
                rest[a] -= k * n

    for i in range(solves):
        if i:
            found = solve(rest, capacity)[0]
        fullest, before = max(map(sum, found)), rest.sum()
        good = {c: x for c, x in found.items() if sum(c) >= share * fullest}
        for items, x in sorted(good.items(), key=lambda c: (-c[1], c[0])):
            take(items, math.floor(x))
        for items in sorted(good, key=lambda c: (math.floor(good[c]) - good[c], c)):
            take(items, 1)
        # a program that places next to nothing of what is left would not place more of it
        if not rest.any() or before - rest.sum() < 0.02 * before:
            break
    return out, rest


def plan(histogram: np.ndarray, capacity: int = CAPACITY, report: dict | None = None) -> dict[tuple[int, ...], int]:
    """Whole configurations that hold exactly histogram[l] pieces of every length: of the roundings the one of fewest sequences.

    Each is ended by best fit, into the room that its own configurations leave first; best fit alone is tried as well, and
    of plans of as many sequences that one holds of which the program placed the most. report: gets the lower bound and the
    pieces that best fit placed.
    """
    if not histogram.any():
        return {}
    found, bound = solve(histogram, capacity)
    alone = fill(histogram, capacity)
    best = (sum(alone.values()), int(histogram.sum()), alone)
    for share in FULLS:
        taken, rest = rounded(histogram, capacity, found, share, SOLVES if share == FULLS[0] else 1)
        whole = fill(rest, capacity, taken)
        best = min(best, (sum(whole.values()), int(rest.sum()), whole), key=lambda p: p[:2])
    if report is not None:
        report.update(bound=bound, by_best_fit=best[1])
    return best[2]


# --- slots -------------------------------------------------------------------------------------------------


def slots(configs: dict[tuple[int, ...], int]) -> pd.DataFrame:
    """Rank ranges of each length: rank r of a range stands in sequence first + (r - lo) div times, at offset + ((r - lo) mod times) * length."""
    rows, taken, sequence = [], {}, 0
    for items, n in sorted(configs.items(), reverse=True):
        at = 0
        kinds, times = np.unique(items, return_counts=True)
        for a, k in zip(kinds.tolist()[::-1], times.tolist()[::-1], strict=True):
            lo = taken.get(a, 0)
            rows.append((a, lo, k, sequence, at))
            taken[a], at = lo + n * k, at + a * k
        sequence += n
    return pd.DataFrame(rows, columns=["length", "lo", "times", "first", "at"]).sort_values(["length", "lo"], ignore_index=True)


def ranked(pieces: DataFrame, keys: list[str], rank: str) -> tuple[DataFrame, np.ndarray]:
    """pieces with a rank: 0, 1, ... within each length, and the histogram. A length that many pieces share is ranked by many tasks."""
    salt, own, before = (fresh(pieces, n) for n in ("salt", "own", "before"))
    # one row a length: no more than the capacity has
    sizes = scratch(pieces.groupBy("length").agg(F.count("*").alias(own)).withColumn(salt, F.ceil(F.col(own) / RANKED)), "lengths")
    histogram = {r["length"]: r[own] for r in sizes.collect()}
    out = np.zeros(max((a or 0 for a in histogram), default=0) + 1, np.int64)
    for a, n in histogram.items():
        if not a or a < 0:
            raise ValueError("lengths must be 1 to the capacity")
        out[a] = n
    salted = pieces.join(F.broadcast(sizes.drop(own)), "length").withColumn(salt, F.pmod(F.xxhash64(*keys), F.col(salt)).cast("int"))
    counts = salted.groupBy("length", salt).agg(F.count("*").alias(own))
    above = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch(counts.select("length", salt, F.coalesce(F.sum(own).over(above), F.lit(0)).alias(before)), "ranks")
    within = Window.partitionBy("length", salt).orderBy(*keys)
    placed = salted.withColumn(own, F.row_number().over(within)).join(counts, ["length", salt])
    return placed.withColumn(rank, F.col(before) + F.col(own) - 1).drop(salt, own, before), out


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """pieces (with `length` of 1 to capacity; all columns) with sequence_id and offset. keys: columns that order pieces of one length."""
    taken = {c.lower() for c in pieces.columns} & {"sequence_id", "offset"}
    if taken:
        raise ValueError(f"columns to be added are there already: {sorted(taken)}")
    rank, place = fresh(pieces, "rank"), fresh(pieces, "slot")
    placed, histogram = ranked(pieces, keys, rank)
    if len(histogram) > capacity + 1:
        raise ValueError("lengths must be 1 to the capacity")
    histogram = np.pad(histogram, (0, capacity + 1 - len(histogram)))
    table = slots(plan(histogram, capacity))  # configurations of the program and of fill(), a number that the capacity bounds: no growth with the pieces
    lo, times, first, at = (table[c].to_numpy(np.int64) for c in ("lo", "times", "first", "at"))
    span = int(histogram.max(initial=0)) + 1
    order = table["length"].to_numpy(np.int64) * span + lo

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        a, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        k = np.searchsorted(order, a * span + r, "right") - 1
        i = r - lo[k]
        return pd.DataFrame({"sequence_id": first[k] + i // times[k], "offset": at[k] + i % times[k] * a})

    return placed.withColumn(place, slot("length", rank)).select(*pieces.columns, f"{place}.sequence_id", f"{place}.offset")


def pack_texts(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    pieces = scratch(tokenize_pieces(df, path, capacity), "pieces")
    return pack(pieces, ["doc_id", "piece", "start", "ids_crc32"], capacity)
