"""Removal of long strings that stand in the corpus more than once, by merging shard Burrows-Wheeler transforms.

1. Every window of LENGTH bytes is named by the least hash of its K-byte grams. Neighbouring windows of one name
   form a run; equal windows have the same name, so a window is repeated only if its name has two grams. Names
   with one gram in the corpus are put aside: all that is unique leaves here.
2. Runs of equal bytes are counted together; where one stands twice, all its windows are repeated.
3. The rest (runs that differ from all others of their name, at the borders of repeats) is sent by name to
   tasks. A task sorts the suffixes of each shard once, over symbols of BLOCK bytes. Shard transforms are then
   merged: the interleave of the shards is refined symbol by symbol from the transforms alone, while classes of
   equal prefixes are split (the common prefixes). After LENGTH / BLOCK rounds a class of two or more is an
   interval of a string of LENGTH bytes that starts at two or more places.
   A name whose different runs have more than HOT bytes would fill one task: its windows are counted by hash instead, in
   chunks, of which equal windows are one row with their places.

Hashes of spans are sums over mixed words of eight bytes, so no two texts can be made to agree whatever the base. Runs
of one name agree by two 64-bit hashes, that of the name's gram and that of the run; texts are told apart by two as well.

Nulls: a null text is the empty one; texts shorter than LENGTH bytes keep all bytes. Rows with equal texts are
places of their own, whatever their doc_id. Very long texts are cut into runs like all others. Ties: all places of a
string are repeated, none is kept for the others. Empty tables give empty tables. doc_id is an integer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, map_rows, mix, scratch, span_hash, sums_of

LENGTH, K, BLOCK = 200, 48, 50
#: Bytes of runs of one name that are merged at once; of runs in a shard; of runs in one merge (and its name's rest).
HOT, SHARD, TASK = 3 << 19, 1 << 19, 2 << 20
#: Windows of a long text that are named at once, and that are counted by hash at once.
PART, CHUNK = 1 << 20, 1 << 18
#: Bytes of rows under which one side of a join is sent to all tasks.
SMALL = 8 << 20


def sliding(x: np.ndarray, width: int, least: np.ufunc, fill: int) -> np.ndarray:
    """least of every `width` neighbours, by prefixes and suffixes of blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, fill, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    head = least.accumulate(blocks, axis=1).ravel()
    tail = least.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return least(tail[:n], head[width - 1 : width - 1 + n])


WIDE = 8


def wide_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums over the mixed WIDE-byte words that start at each byte: no sum of bytes alone, so texts that are built for the sums to agree don't."""
    n = max(0, len(data) - WIDE + 1)
    word = np.zeros(n, np.uint64)
    for k in range(WIDE):
        word |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    return sums_of(mix(word))


def wide_span(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of WIDE bytes at least."""
    return span_hash(prefix, starts, ends - (WIDE - 1))


def text_keys(text: Column, *names: str) -> list[Column]:
    """Two 64-bit hashes of a text, which stand for it where texts are not moved."""
    keys = [F.xxhash64(text), F.xxhash64(F.lit("again"), text)]
    return [k.alias(n) for k, n in zip(keys, names, strict=True)] if names else keys


def name_runs(text: bytes) -> tuple[np.ndarray, ...] | None:
    """Of every run: name, hash of its bytes, first window, last window + 1, grams of this name in the text (2 for more)."""
    data = np.frombuffer(text, np.uint8)
    n, width = len(data), LENGTH - K + 1
    if n < LENGTH:
        return None
    p = wide_hash(data)
    at = np.arange(n - K + 1)
    gram = mix(wide_span(p, at, at + K) ^ np.uint64(0x2545F4914F6CDD1D))
    name = sliding(gram, width, np.minimum, 2**64 - 1)
    lo = np.concatenate(([0], np.flatnonzero(name[1:] != name[:-1]) + 1))
    hi = np.concatenate((lo[1:], [len(name)]))
    # a gram names a window if it is the greatest name among the windows that hold it
    around = np.concatenate((np.zeros(width - 1, np.uint64), name, np.zeros(width - 1, np.uint64)))
    named, count = np.unique(gram[gram == sliding(around, width, np.maximum, 0)], return_counts=True)
    return name[lo], wide_span(p, lo, hi - 1 + LENGTH), lo, hi, np.minimum(count[np.searchsorted(named, name[lo])], 2)


RUNS = pa.schema([("name", pa.int64()), ("bytes_hash", pa.int64()), ("text_hash", pa.int64()), ("text_more", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("grams", pa.int32())])


def runs_of(texts: DataFrame) -> DataFrame:
    """The runs of every text, in parts of PART windows: where a part ends, a run is cut."""

    def make():
        def step(c):
            parts: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in (np.uint64, np.uint64, np.int64, np.int64, np.int32, np.int32, np.int32)]
            for key, more, t in zip(c["text_hash"], c["text_more"], c["text"], strict=True):
                raw = t.encode()
                for at in range(0, max(0, len(raw) - LENGTH + 1), PART):
                    name, own, lo, hi, grams = name_runs(raw[at : at + PART + LENGTH - 1])
                    for part, x in zip(parts, (name, own, np.full(len(name), key), np.full(len(name), more), lo + at, hi + at, grams), strict=True):
                        part.append(x)
            out = [np.concatenate(p) for p in parts]
            return dict(zip(RUNS.names, (out[0].view(np.int64), out[1].view(np.int64), out[2], out[3], *(x.astype(np.int32) for x in out[4:])), strict=True))

        return step

    return map_rows(texts, make, RUNS, rows=256)


# --- shards and their merge ----------------------------------------------------------------------------------


def radix_order(key: np.ndarray, most: int) -> np.ndarray:
    """Stable order of whole numbers from 0 to most: digits of 16 bits, the last one first."""
    order = np.argsort(key.astype(np.uint16), kind="stable")
    for shift in range(16, int(most).bit_length(), 16):
        digit = (key[order] >> key.dtype.type(shift)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


def ranks(key: np.ndarray, most: int) -> np.ndarray:
    """0, 1, ... by size, equal for equal numbers."""
    order = radix_order(key, most)
    by_size = key[order]
    out = np.zeros(len(key), np.int64)
    out[order[1:]] = np.cumsum(by_size[1:] != by_size[:-1])
    return out


def begins(ordered: np.ndarray) -> np.ndarray:
    """Of every place the first of the run of equal numbers that it stands in."""
    new = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1))
    return np.repeat(new, np.diff(np.concatenate((new, [len(ordered)]))))


class Shard:
    """Snippets as one text of block symbols: suffixes in order, and the symbol before each (the transform)."""

    def __init__(self, snippets: list[bytes]):
        # symbols: the hash of the BLOCK bytes from each place; the last BLOCK places of a snippet are ends (0)
        self.sizes = np.array([len(s) + 1 for s in snippets])
        data = np.frombuffer(b"\0".join([*snippets, b""]), np.uint8)
        p, at = wide_hash(data), np.arange(len(data))
        ends = np.repeat(np.cumsum(self.sizes), self.sizes)
        whole = at < ends - BLOCK
        self.symbols = np.zeros(len(data), np.uint64)
        self.symbols[whole] = wide_span(p, at[whole], at[whole] + BLOCK) | np.uint64(1)
        self.order = self._sort(ends)

    def _sort(self, ends: np.ndarray) -> np.ndarray:
        """Suffix order by doubling over 1, 2, 4, ... blocks. An end sorts first, equal suffixes by place.

        A rank is the place where its class begins, so a class is split where it stands: those of one suffix, and those
        that have come to their end, are looked at no more.
        """
        n, step = len(self.symbols), BLOCK
        active = radix_order(self.symbols, 2**64 - 1)
        rank = np.empty(n, np.int64)
        rank[active] = begins(self.symbols[active])
        while True:
            r = rank[active]
            same = r[1:] == r[:-1]
            several = np.concatenate((same, [False])) | np.concatenate(([False], same))
            active = active[several & (active + step < ends[active])]
            if not len(active):
                return radix_order(rank, n)
            r, follow = rank[active], rank[active + step]
            key = r * n + follow
            o = radix_order(key, n * n)
            active, r, key = active[o], r[o], key[o]
            rank[active] = r + begins(key) - begins(r)
            step *= 2

    @property
    def transform(self) -> np.ndarray:
        first = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        before = np.arange(len(self.symbols)) - BLOCK
        out = np.where(before >= first, self.symbols[np.maximum(before, 0)], np.uint64(0))
        return out[self.order]


def merge_shards(shards: list[Shard], rounds: int) -> list[np.ndarray]:
    """For every shard and suffix (by place): how many suffixes of all shards share its first `rounds` symbols; 0 where it is shorter.

    source: which shard each place of the interleave takes its next suffix from. One round sorts the
    transforms' symbols stably in the order of the interleave; what stands before the suffixes that shared h
    symbols then shares h + 1.
    """
    sizes = [len(s.order) for s in shards]
    source = np.repeat(np.arange(len(shards), dtype=np.int32), sizes)
    transforms = np.concatenate([s.transform for s in shards])
    symbol, is_end = ranks(transforms, 2**64 - 1), transforms == 0
    kinds = int(symbol.max(initial=0))
    first = np.cumsum([0, *sizes[:-1]])
    group, whole = np.zeros(len(source), np.int32), np.ones(len(source), bool)

    def places(source: np.ndarray) -> np.ndarray:
        """Index into the concatenated transforms of every place of the interleave."""
        out = np.empty(len(source), np.int64)
        out[radix_order(source, len(shards))] = np.arange(len(source))
        return out

    for _ in range(rounds):
        now = places(source)
        c = symbol[now]
        order = radix_order(c, kinds)
        c, g = c[order], group[order]
        whole = whole[order] & ~is_end[now[order]]
        source = source[order]
        group = np.concatenate(([0], np.cumsum((c[1:] != c[:-1]) | (g[1:] != g[:-1])))).astype(np.int32)
    now = places(source)
    count = np.bincount(group[whole], minlength=len(group) + 1)[group] * whole
    by_suffix = np.empty(len(source), np.int64)
    by_suffix[now] = count
    out = []
    for k, s in enumerate(shards):
        at = np.empty(sizes[k], np.int64)
        at[s.order] = by_suffix[first[k] : first[k] + sizes[k]]
        out.append(at)
    return out


def repeated_starts(snippets: list[bytes]) -> list[np.ndarray]:
    """Of every snippet the starts of strings of LENGTH bytes that start at another place of the snippets, too."""
    cuts, size = [0], 0
    for i, s in enumerate(snippets):
        if size and size + len(s) > SHARD:
            cuts.append(i)
            size = 0
        size += len(s)
    shards = [Shard(snippets[a:b]) for a, b in zip(cuts, [*cuts[1:], len(snippets)], strict=True)]
    out = []
    for shard, counts in zip(shards, merge_shards(shards, LENGTH // BLOCK), strict=True):
        ends = np.cumsum(shard.sizes)
        out += [np.flatnonzero(counts[b - n : b] > 1) for b, n in zip(ends, shard.sizes, strict=True)]
    return out


RANGES = pa.schema([("text_hash", pa.int64()), ("text_more", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _starts_to_ranges(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > 1) + 1
        for a, b in zip([0, *cut], [*cut, len(starts)], strict=True):
            yield int(starts[a]), int(starts[b - 1]) + 1


def _merged(snippets: DataFrame) -> DataFrame:
    """Ranges of repeated windows among the snippets of each name; snippets: name, text_hash, text_more, lo, twice, snippet."""
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # all of a name stands together; tasks' sizes are set by their number, and a name's by HOT
        rows = [*batches]
        if not rows:
            return
        table = pa.Table.from_batches(rows).to_pydict()
        held, size, names = [], 0, table["name"]
        for i, s in enumerate(table["snippet"]):
            held.append(i)
            size += len(s)
            if size >= TASK and (i + 1 == len(names) or names[i + 1] != names[i]):
                yield flush(table, held)
                held, size = [], 0
        if held:
            yield flush(table, held)
        del table, rows
        give_back()

    def flush(table: dict, held: list[int]) -> pa.RecordBatch:
        rows = []
        for i, starts in zip(held, repeated_starts([table["snippet"][i] for i in held]), strict=True):
            if not table["twice"][i]:
                lo = table["lo"][i]
                rows += [(table["text_hash"][i], table["text_more"][i], lo + a, lo + b) for a, b in _starts_to_ranges(starts)]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, RANGES, strict=True)], schema=RANGES)

    return snippets.sortWithinPartitions("name").mapInArrow(run, from_arrow_schema(RANGES))


def _counted(snippets: DataFrame) -> DataFrame:
    """The same for names of very many runs: every window by its hash and its name's, in chunks whose equal windows are one row with their places."""
    from pyspark.sql.pandas.types import from_arrow_schema

    schema = pa.schema([("name", pa.int64()), ("window", pa.int64()), ("text_hash", pa.int64()), ("text_more", pa.int64()), ("chunk", pa.int32()), ("twice", pa.bool_()), ("n", pa.int64()), ("places", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("name", "text_hash", "text_more", "lo", "twice")}
                snippet = np.frombuffer(batch.column("snippet")[i].as_buffer(), np.uint8)
                for start in range(0, len(snippet) - LENGTH + 1, CHUNK):
                    part = snippet[start : start + CHUNK + LENGTH - 1]
                    at = np.arange(len(part) - LENGTH + 1)
                    window = wide_span(wide_hash(part), at, at + LENGTH)
                    order = np.argsort(window, kind="stable")
                    window = window[order]
                    first = np.concatenate(([0], np.flatnonzero(window[1:] != window[:-1]) + 1))
                    ends = np.append(first, len(window))
                    places = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((ends * 4).astype("<i4").tobytes()), pa.py_buffer(order.astype("<i4").tobytes())])
                    same = {n: pa.array(np.full(len(first), row[n] if n != "chunk" else row["lo"] + start), f.type) for n, f in zip(schema.names, schema, strict=True) if n in row or n == "chunk"}
                    cols = same | {"window": pa.array(window[first].view(np.int64)), "n": pa.array(np.diff(ends)), "places": places}
                    yield pa.RecordBatch.from_arrays([cols[n] for n in schema.names], schema=schema)
        give_back()

    def make():
        def step(c):
            rows = []
            for key, more, lo, places in zip(c["text_hash"], c["text_more"], c["chunk"], c["places"], strict=True):
                starts = np.sort(np.frombuffer(b"".join(places), "<i4"))
                rows += [(key, more, lo + a, lo + b) for a, b in _starts_to_ranges(starts)]
            return dict(zip(RANGES.names, list(zip(*rows, strict=True)) or [()] * 4, strict=True))

        return step

    windows = scratch(snippets.mapInArrow(run, from_arrow_schema(schema)), "windows")
    again = windows.groupBy("name", "window").agg(F.sum("n").alias("all")).filter("all > 1")
    # of a chunk four bytes a window at most
    found = windows.filter("not twice").join(again, ["name", "window"], "left_semi").groupBy("text_hash", "text_more", "chunk").agg(F.collect_list("places").alias("places"))
    return map_rows(found, make, RANGES, rows=16)


def repeated_windows(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """text_hash, text_more (together the text's 128-bit hash), lo, hi: starts lo to hi - 1 of windows of LENGTH bytes that stand in docs (text) again."""
    texts = docs.select(*text_keys(F.col("text"), "text_hash", "text_more"), "text")
    runs = scratch(runs_of(texts), "runs")
    names = runs.groupBy("name").agg(F.sum("grams").alias("n")).filter("n > 1").select("name")
    own = ["name", "bytes_hash", "text_hash", "text_more", "lo", "hi", "grams"]
    found = scratch(runs.join(scratch(names, "names"), "name", "left_semi").groupBy(*own).agg(F.count("*").alias("m")), "found")
    equal = scratch(found.groupBy("name", "bytes_hash").agg(F.sum("m").alias("m"), F.max("grams").alias("grams"), F.min(F.struct("text_hash", "text_more", "lo", "hi")).alias("one")), "equal")
    whole = found.drop("m").join(equal.filter("m > 1").select("name", "bytes_hash"), ["name", "bytes_hash"], "left_semi").select("text_hash", "text_more", "lo", "hi")
    # names with runs that have no equal: all their different runs meet
    mixed = equal.groupBy("name").agg(F.count("*").alias("runs"), F.sum(F.col("one.hi") - F.col("one.lo") + LENGTH).alias("size"), F.sum((F.col("m") == 1).cast("int")).alias("single"), F.max("grams").alias("grams"))
    mixed = scratch(mixed.filter("single > 0 and (runs > 1 or grams > 1)").select("name", "size"), "mixed")
    wanted = scratch(equal.join(mixed, "name").select("name", "size", (F.col("m") > 1).alias("twice"), "one.text_hash", "one.text_more", "one.lo", "one.hi"), "wanted")
    size = wanted.agg(F.coalesce(F.sum(F.col("hi") - F.col("lo") + LENGTH), F.lit(0)).alias("bytes")).first()
    snippets = scratch(_cut(texts, wanted), "snippets")
    parts = max(1, math.ceil(size["bytes"] / TASK))
    merged = _merged(snippets.filter(F.col("size") <= hot).repartition(parts, "name"))
    return whole.unionByName(merged).unionByName(_counted(snippets.filter(F.col("size") > hot)))


def _cut(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted runs, from one row of each text."""
    lists = wanted.groupBy("text_hash", "text_more").agg(F.collect_list(F.struct("name", "size", "twice", "lo", "hi")).alias("cuts"))
    # of all texts only those that hold a wanted run are moved
    keys = scratch(wanted.select("text_hash").distinct(), "keys")
    some = texts.join(F.broadcast(keys) if keys.count() * 16 <= SMALL else keys, "text_hash", "left_semi")
    some = some.groupBy("text_hash", "text_more").agg(F.first("text").alias("text"))
    schema = pa.schema([("name", pa.int64()), ("size", pa.int64()), ("twice", pa.bool_()), ("text_hash", pa.int64()), ("text_more", pa.int64()), ("lo", pa.int32()), ("snippet", pa.binary())])

    def make():
        def step(c):
            out = {f.name: [] for f in schema}
            for key, more, text, cuts in zip(c["text_hash"], c["text_more"], c["text"], c["cuts"], strict=True):
                raw = text.encode()
                for x in cuts:
                    for k in ("name", "size", "twice", "lo"):
                        out[k].append(x[k])
                    out["text_hash"].append(key)
                    out["text_more"].append(more)
                    out["snippet"].append(raw[x["lo"] : x["hi"] - 1 + LENGTH])
            return out

        return step

    return map_rows(some.join(lists, ["text_hash", "text_more"]).select("text_hash", "text_more", "text", "cuts"), make, schema, rows=128)


def kept_mask(n: int, ranges: list) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    if ranges:
        lo, hi = np.array([[r["lo"], r["hi"]] for r in ranges]).T
        np.add.at(edge, lo, 1)
        np.add.at(edge, hi - 1 + LENGTH, -1)
    return np.cumsum(edge[:n]) == 0


def with_ranges(docs: DataFrame, name: str, hot: int = HOT) -> DataFrame:
    """docs (all columns, null texts empty) with `name`: the starts of repeated windows in its text, null without any."""
    found = repeated_windows(docs.select(F.coalesce("text", F.lit("")).alias("text")), hot)
    key, more = fresh(docs, "text_hash"), fresh(docs, "text_more")
    ranges = found.groupBy("text_hash", "text_more").agg(F.collect_set(F.struct("lo", "hi")).alias(name)).withColumnsRenamed({"text_hash": key, "text_more": more})
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns(dict(zip((key, more), text_keys(text), strict=True)) | {"text": text})
    return rows.join(scratch(ranges, "ranges"), [key, more], "left").drop(key, more)


def digest_kept(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def make():
        def step(c):
            out = {f.name: [] for f in schema}
            for key, text, ranges in zip(c["doc_id"], c["text"], c["ranges"], strict=True):
                raw = text.encode()
                keep = kept_mask(len(raw), ranges)
                gone = np.concatenate(([False], ~keep))
                kept = raw if keep.all() else np.frombuffer(raw, np.uint8)[keep].tobytes()
                for k, v in zip(schema.names, (key, len(raw), int((~keep).sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()), strict=True):
                    out[k].append(v)
            return out

        return step

    return map_rows(with_ranges(docs.select("doc_id", "text"), "ranges", hot), make, schema)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """docs, all rows and columns, without the repeated bytes; of a character that a removed span cuts through nothing stays."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, ranges: pd.Series) -> pd.Series:
        out = []
        for t, r in zip(text, ranges, strict=True):
            if r is None or not len(r):
                out.append(t)
                continue
            raw = np.frombuffer(t.encode(), np.uint8)
            out.append(raw[kept_mask(len(raw), list(r))].tobytes().decode(errors="ignore"))
        return pd.Series(out, dtype=object)

    ranges = fresh(docs, "ranges")
    return with_ranges(docs, ranges, hot).withColumn("text", cut("text", ranges)).select(*docs.columns)
