"""Alignment of two tokenizers over a corpus: groups between common ends, overlapping tokens, and how usual each id pair is.

Tokens of A and B cut a text's bytes at their ends. Between two neighbouring ends of either stands one link: the A token
and the B token that overlap there. Ends of both close a group. A pair's count is the number of documents that hold it linked.

Counting is external. Tasks encode documents, turn them into pair-document records, part these by a radix of the A id and
leave them as sorted zstd runs, a slice of documents and radix each (a table under the shared folder, so lost executors cost
nothing). A radix's runs meet in one task, which merges the pairs of FAN runs at once by a heap of block ends, in levels, with
finished levels spilled; as the order has A ids first, an A id's highest count is known when the id is done. Then totals
and runs meet again, totals first by secondary sort, and every run gives back its documents' sums of counts and of best links.
A radix of many runs is split by salts, in numbers that follow its bytes; totals are bounded by the vocabularies and copied to
each salt. Nothing that grows with the corpus is held but one slice, one block a run, and one radix's totals.

Both vocabularies are encoded by libraries: A whole texts at a time, B a distinct run up to the next space at a time, as no
piece of B spans from another character to a space.

Nulls: null and empty texts have no tokens, nor have texts whose joined token bytes differ from space + text (U+2581 in the
text, for one): zeros and an empty digest. Ties for an A id's highest count are all best. Repeated rows, and rows without or
with the same doc_id, are documents each for itself. Very long texts: a text is a slice of its own if need be, and takes
some 200 bytes a token while it is worked on. Empty tables give empty tables. Further columns are left alone.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import json
import re
import struct
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from .common import give_back, scratch, ship

#: Distinct runs up to a space in each of two generations of a worker's memory, and the length of those that are remembered.
CACHED, LONGEST = 200_000, 48
#: Bytes of text that are aligned at once, records and documents of a slice.
BATCH, RECORDS, SLICE = 1 << 20, 2_000_000, 60_000
#: Radixes of the A ids: shuffle partitions, within these bounds.
LEAST, MOST = 64, 8192
#: Pairs of a block, runs of a merge, bytes of finished levels in memory, bytes of runs a salt.
BLOCK, FAN, SPOOL, SALT = 1 << 14, 256, 1 << 24, 1 << 26
#: Pairs of a row of totals; an A id's pairs stand in one row.
CHUNK = 1 << 17
#: Bits of a B id, of a pair of ids, and of a document's number in its slice.
B_BITS, PAIR_BITS, DOC_BITS = 15, 32, 16
SPACE_MARK = "▁"


# --- the two vocabularies ------------------------------------------------------------------------------------


def _unmapped() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the numbers under n: their digits and room for an end behind them, and how many there are."""
    said = [str(i).encode() for i in range(n)]
    size = np.array([len(x) for x in said], np.int64)
    wide = int(size.max()) + 1
    return np.frombuffer(b"".join(x.ljust(wide) for x in said), np.uint8).reshape(n, wide), size


class Bytes:
    """Side A: byte-level merges. The library encodes whole texts; what it gives joins to the text's bytes, always."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path) as f:
            read = json.load(f)
        byte = _unmapped()
        ranks = {bytes(byte[c] for c in token): i for token, i in read["model"]["vocab"].items() if all(c in byte for c in token)}
        for extra in read["added_tokens"]:
            ranks.pop(extra["content"].encode(), None)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        order = [read["model"]["vocab"][x + y] for x, y in pairs]
        if order != sorted(order):
            raise ValueError("ids don't follow the merges")
        self.encode = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        table = {i: b for b, i in ranks.items()}
        self.lengths = np.array([len(table.get(i, b"")) for i in range(max(table) + 1)], np.int64)

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.encode(t), "<u4").tobytes() for t in texts]


class Pieces:
    """Side B: pieces with byte fallback, encoded a run up to the next space at a time; None if a text's pieces don't join to it."""

    def __init__(self, path: str):
        import sentencepiece

        b = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces):
            raise ValueError("a piece spans from a word to a space: runs can't be encoded alone")
        self.table = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(SPACE_MARK, " ").encode() for p in pieces]
        self.lengths = np.array([len(x) for x in self.table], np.int64)
        self.one = [b.piece_to_id(SPACE_MARK)]
        self.cut = re.compile(" *[^ ]+| +").findall
        self.known: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def _of(self, run: str, ids: list[int]) -> bytes | None:
        return array.array("I", ids).tobytes() if b"".join(map(self.table.__getitem__, ids)) == run.encode() else None

    def ids(self, texts: list[str]) -> list[bytes | None]:
        cut = list(map(self.cut, texts))
        every = set().union(*cut)
        if len(self.known) > CACHED:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        late = []
        for run in every - known.keys():
            if run in old:
                known[run] = old[run]
            else:
                late.append(run)
        # The library puts a space before what it encodes, and makes nothing of nothing.
        for run, ids in zip(late, self.library.encode([run[1:] for run in late], num_threads=1), strict=True):
            known[run] = self._of(run, ids or self.one)
        out = []
        for runs in cut:
            found = list(map(known.__getitem__, runs))
            out.append(None if None in found else b"".join(found))
        for run in late:
            if len(run) > LONGEST:
                del known[run]
        return out


@lru_cache(2)
def sides(path_a: str, path_b: str, pattern: str) -> tuple[Bytes, Pieces]:
    """One a worker process."""
    left, right = Bytes(path_a, pattern), Pieces(path_b)
    if len(right.lengths) > 1 << B_BITS or len(left.lengths) > 1 << PAIR_BITS - B_BITS:
        raise ValueError("a vocabulary is too large for the records")
    return left, right


# --- groups and links ----------------------------------------------------------------------------------------


def _decimals(ids: np.ndarray, ends: np.ndarray, digits: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the numbers in decimal, each followed by its end, and where each stops."""
    rows, size = digits[ids], sizes[ids]
    rows[np.arange(len(ids)), size] = ends
    return rows[np.arange(digits.shape[1]) <= size[:, None]], np.cumsum(size + 1)


def align(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of one or more texts' tokens laid end to end: place of each link's last byte, its A and B token, and whether a group ends there."""
    size = int(ends_a[-1])
    in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
    in_a[ends_a - 1] = True
    in_b[ends_b - 1] = True
    at = np.flatnonzero(in_a | in_b)
    here_a, here_b = in_a[at], in_b[at]
    return at, np.cumsum(here_a) - here_a, np.cumsum(here_b) - here_b, here_a & here_b


def _said(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray, ends: np.ndarray, digits: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All groups as text, each ended by ";": bytes, where each token's part stops, and the tokens (of both) up to each group's end."""
    upto_a, upto_b = ia[ends] + 1, ib[ends] + 1
    group_a = np.repeat(np.arange(len(upto_a)), np.diff(upto_a, prepend=0))
    group_b = np.repeat(np.arange(len(upto_b)), np.diff(upto_b, prepend=0))
    i, j = np.arange(len(a)), np.arange(len(b))
    slot_a = i + np.concatenate(([0], upto_b[:-1]))[group_a]
    slot_b = j + upto_a[group_b]
    ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[slot_a], ids[slot_b] = a, b
    marks[slot_a[upto_a - 1]] = ord("|")
    marks[slot_b[upto_b - 1]] = ord(";")
    text, stops = _decimals(ids, marks, digits, sizes)
    return text, stops, upto_a + upto_b


def radix_of(n: int, radixes: int) -> np.ndarray:
    """The radix of each of n A ids."""
    return ((np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % radixes


# --- runs ----------------------------------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """A block: its arrays' bytes under zstd, after their lengths."""
    raw = b"".join(x.tobytes() for x in arrays)
    body = zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(arrays)}I", *(x.nbytes for x in arrays)) + raw)
    return struct.pack("<I", len(body)) + body


def _unpack(body: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    at, out = 4 * len(types), []
    for size, kind in zip(struct.unpack_from(f"<{len(types)}I", raw), types, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def write_run(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run of pairs and their counts, in blocks."""
    return b"".join(_pack(np.diff(pairs[i : i + BLOCK], prepend=0).astype("<u4"), counts[i : i + BLOCK].astype("<u8" if counts.max() >> 32 else "<u4")) for i in range(0, len(pairs), BLOCK))


def read_run(read) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a run from read(n bytes)."""
    while head := read(4):
        body = read(struct.unpack("<I", head)[0])
        steps, raw = _unpack(body, "<u4", "u1")
        kind = "<u4" if len(raw) == 4 * len(steps) else "<u8"
        yield np.cumsum(steps, dtype=np.int64), raw.view(kind).astype(np.int64)


def reader(blob: bytes):
    at = 0

    def read(n: int) -> bytes:
        nonlocal at
        at += n
        return blob[at - n : at]

    return read


def merge(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums of counts by pair, in order. A heap of block ends says how far all runs are known; one block a run is held."""
    live: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(k: int) -> None:
        block = next(runs[k], None)
        if block is not None:
            live[k] = block
            heapq.heappush(heap, (int(block[0][-1]), k))
        else:
            live.pop(k, None)

    for k in range(len(runs)):
        load(k)
    while heap:
        bound, parts = heap[0][0], []
        for k, (pairs, counts) in live.items():
            n = int(np.searchsorted(pairs, bound, "right"))
            if n:
                parts.append((pairs[:n], counts[:n]))
                live[k] = (pairs[n:], counts[n:])
        while heap and heap[0][0] == bound:
            load(heapq.heappop(heap)[1])
        pairs = np.concatenate([p for p, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        yield pairs[first], np.add.reduceat(counts[order], first)


class Levels:
    """Runs in any number: every FAN runs of a level are merged into one of the next, which is spilled."""

    def __init__(self):
        self.levels: list[list] = []

    def add(self, blob: bytes) -> None:
        self._put(0, reader(blob))

    def _put(self, level: int, read) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(read)
        if len(self.levels[level]) == FAN:
            runs, self.levels[level] = self.levels[level], []
            spool = tempfile.SpooledTemporaryFile(SPOOL)
            for pairs, counts in merge([read_run(r) for r in runs]):
                spool.write(write_run(pairs, counts))
            spool.seek(0)
            self._put(level + 1, spool.read)

    def totals(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return merge([read_run(r) for level in self.levels for r in level])


# --- stages --------------------------------------------------------------------------------------------------


class Slice:
    """Documents of a task until their records are written as one run a radix."""

    def __init__(self, left: Bytes, right: Pieces, radixes: int):
        self.left, self.right = left, right
        self.radix, self.radixes = radix_of(len(left.lengths), radixes), radixes
        self.digits = _digits(max(len(left.lengths), len(right.lengths)))
        self.clear()

    def clear(self) -> None:
        self.rows, self.records, self.times, self.n = [], [], [], 0

    def add(self, keys: list, texts: list[str]) -> None:
        zero = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
        said = [" " + t if t else "" for t in texts]
        every_a, every_b = self.left.ids(said), self.right.ids(said)
        rows = [{"doc_id": k} | zero for k in keys]
        have = [i for i, (x, y) in enumerate(zip(every_a, every_b, strict=True)) if x and y]
        start = len(self.rows)
        self.rows += rows
        if not have:
            return
        a, b = (np.frombuffer(b"".join(s[i] for i in have), "<u4").astype(np.int64) for s in (every_a, every_b))
        ends_a, ends_b = np.cumsum(self.left.lengths[a]), np.cumsum(self.right.lengths[b])
        stop_a, stop_b = (np.cumsum([len(s[i]) // 4 for i in have]) for s in (every_a, every_b))
        at, ia, ib, ends = align(a, b, ends_a, ends_b)
        text, stops, upto = _said(a, b, ia, ib, ends, *self.digits)
        stop_links = np.searchsorted(at, ends_a[stop_a - 1] - 1) + 1
        stop_groups = np.cumsum(ends)[stop_links - 1]
        stop_text = stops[upto[stop_groups - 1] - 1]
        shown = text.tobytes()
        n_links = np.diff(stop_links, prepend=0)
        numbers = [np.diff(x, prepend=0).tolist() for x in (stop_a, stop_b, stop_groups, stop_links)]
        before = 0
        for i, *ns, stop in zip(have, *numbers, stop_text.tolist(), strict=True):
            rows[i].update(zip(("n_a", "n_b", "n_groups", "n_links"), ns, strict=True), groups_sha256=hashlib.sha256(shown[before : stop - 1]).hexdigest())
            before = stop
        la = a[ia]
        record = (self.radix[la] << PAIR_BITS | la << B_BITS | b[ib]) << DOC_BITS | np.repeat(np.array(have) + start, n_links)
        record.sort()
        first = np.flatnonzero(np.diff(record, prepend=-1))
        self.records.append(record[first])
        self.times.append(np.diff(np.append(first, len(record))))
        self.n += len(first)

    def flush(self, number: int) -> Iterator[dict]:
        yield {"slice": number, "radix": -1, "size": 0, "pairs": None, "docs": None, "rows": self.rows}
        if self.records:
            record, times = np.concatenate(self.records), np.concatenate(self.times)
            order = np.argsort(record, kind="stable")
            record, times = record[order], times[order]
            cuts = np.searchsorted(record, np.arange(self.radixes + 1, dtype=np.int64) << PAIR_BITS + DOC_BITS)
            for radix in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[radix], cuts[radix + 1])
                pairs = record[part] >> DOC_BITS & (1 << PAIR_BITS) - 1
                first = np.flatnonzero(np.diff(pairs, prepend=-1))
                run = write_run(pairs[first], np.diff(np.append(first, len(pairs))))
                docs = _pack((record[part] & (1 << DOC_BITS) - 1).astype("<u2"), times[part].astype("<u4"))
                yield {"slice": number, "radix": radix, "size": len(run) + len(docs), "pairs": run, "docs": docs, "rows": None}
        self.clear()


def _runs_schema(key: pa.DataType) -> pa.Schema:
    row = pa.struct([("doc_id", key), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])
    return pa.schema([("slice", pa.int64()), ("radix", pa.int32()), ("size", pa.int64()), ("pairs", pa.binary()), ("docs", pa.binary()), ("rows", pa.list_(row))])


def write_runs(df: DataFrame, path_a: str, path_b: str, pattern: str, radixes: int) -> DataFrame:
    """slice, radix, size (bytes), pairs (a run), docs (the documents of its pairs), rows (what is known of the slice's documents; radix -1)."""
    schema = _runs_schema(to_arrow_type(df.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Slice(*sides(path_a, path_b, pattern), radixes)
        number = TaskContext.get().partitionId() << 32
        keys, texts, size = [], [], 0

        def flushed():
            nonlocal number
            for row in now.flush(number):
                yield pa.RecordBatch.from_pylist([row], schema)
            number += 1

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(k)
                texts.append(t.as_py() or "")
                size += len(texts[-1])
                if size >= BATCH or len(texts) >= 4096:
                    now.add(keys, texts)
                    keys, texts, size = [], [], 0
                    if now.n >= RECORDS or len(now.rows) >= SLICE - 4096:
                        yield from flushed()
        if texts:
            now.add(keys, texts)
        if now.rows:
            yield from flushed()
        give_back()

    ship(df.sparkSession)
    return df.select("doc_id", "text").mapInArrow(run, from_arrow_schema(schema))


def count_pairs(runs: DataFrame) -> DataFrame:
    """radix, chunk, pairs (a run of totals), best (a byte for each pair: whether it has its A id's highest count)."""
    schema = pa.schema([("radix", pa.int32()), ("chunk", pa.int32()), ("pairs", pa.binary()), ("best", pa.binary())])

    def counted(radix: int, levels: Levels) -> Iterator[pa.RecordBatch]:
        chunk, wait = 0, []

        def emit(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.diff(pairs >> B_BITS, prepend=-1))
            most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs))))
            return pa.RecordBatch.from_pylist([{"radix": radix, "chunk": chunk, "pairs": write_run(pairs, counts), "best": (counts == most).tobytes()}], schema)

        for part in levels.totals():
            wait.append(part)
            if sum(len(p) for p, _ in wait) >= CHUNK:
                pairs, counts = (np.concatenate(x) for x in zip(*wait, strict=True))
                # A ids before the last one are done.
                cut = int(np.searchsorted(pairs, pairs[-1] >> B_BITS << B_BITS))
                if cut:
                    yield emit(pairs[:cut], counts[:cut])
                    chunk += 1
                wait = [(pairs[cut:], counts[cut:])]
        if wait:
            yield emit(*(np.concatenate(x) for x in zip(*wait, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, levels = None, Levels()
        for batch in batches:
            for radix, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if radix != now:
                    yield from counted(now, levels)
                    now, levels = radix, Levels()
                levels.add(blob.as_py())
        yield from counted(now, levels)
        give_back()

    sorted_runs = runs.filter(F.col("radix") >= 0).select("radix", "pairs").repartition("radix").sortWithinPartitions("radix")
    return sorted_runs.mapInArrow(run, from_arrow_schema(schema))


def give_sums(runs: DataFrame, totals: DataFrame) -> DataFrame:
    """slice, sums: by document of the slice and radix, how many of its links are best, and the sum of its links' counts."""
    schema = pa.schema([("slice", pa.int64()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, total = None, [], None
        for batch in batches:
            for radix, chunk, number, blob, more in zip(*(batch.column(n).to_pylist() for n in ("radix", "chunk", "slice", "pairs", "docs")), strict=True):
                if radix != now:
                    now, parts = radix, []
                pairs, times = (np.concatenate(x) for x in zip(*read_run(reader(blob)), strict=True))
                if chunk is not None:
                    parts.append((pairs, times, np.frombuffer(more, bool)))
                    total = None
                    continue
                if total is None:
                    total = [np.concatenate(x) for x in zip(*parts, strict=True)]
                found = np.searchsorted(total[0], pairs)
                where, often = _unpack(more[4:], "<u2", "<u4")
                often = often.astype(np.int64)
                counts, best = np.repeat(total[1][found], times), np.repeat(total[2][found], times)
                size = int(where.max()) + 1
                # Doubles hold sums of 2**26 numbers under 2**26 as they are.
                low, high, n_best = (np.bincount(where, x, size).astype(np.int64) for x in ((counts & (1 << 26) - 1) * often, (counts >> 26) * often, best * often))
                yield pa.RecordBatch.from_pylist([{"slice": number, "sums": _pack(n_best.astype("<i8"), (low + (high << 26)).astype("<i8"))}], schema)
        give_back()

    # A row a radix: MOST at most.
    salts = F.broadcast(runs.filter(F.col("radix") >= 0).groupBy("radix").agg((F.sum("size") / SALT).cast("int").alias("salts")))
    none = F.lit(None)
    many = totals.join(salts, "radix").select("radix", F.explode(F.sequence(F.lit(0), "salts")).alias("salt"), "chunk", none.cast("long").alias("slice"), "pairs", F.col("best").alias("docs"))
    own = runs.filter(F.col("radix") >= 0).join(salts, "radix").select("radix", F.expr("CAST(pmod(xxhash64(slice), salts + 1) AS INT)").alias("salt"), none.cast("int").alias("chunk"), "slice", "pairs", "docs")
    both = many.unionByName(own).repartition("radix", "salt").sortWithinPartitions("radix", "salt", F.col("chunk").asc_nulls_last())
    return both.mapInArrow(run, from_arrow_schema(schema))


def align_texts(df: DataFrame, path_a: str, path_b: str, pattern: str, radixes: int | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    if radixes is None:
        radixes = min(MOST, max(LEAST, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    key = to_arrow_type(df.schema["doc_id"].dataType)
    runs = scratch(write_runs(df, path_a, path_b, pattern, radixes), "alignment_runs")
    sums = give_sums(runs, scratch(count_pairs(runs), "alignment_totals"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = pa.schema([(n, key if n == "doc_id" else pa.string() if n == "groups_sha256" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, best, total = [], None, None

        def done() -> Iterator[pa.RecordBatch]:
            if rows:
                out = [r | {"n_best": x, "count_sum": y} for r, x, y in zip(rows, best.tolist(), total.tolist(), strict=True)]
                yield pa.RecordBatch.from_pylist(out, schema)

        for batch in batches:
            for own, blob in zip(batch.column("rows").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                if own is not None:
                    yield from done()
                    rows, best, total = own, np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                else:
                    x, y = _unpack(blob[4:], "<i8", "<i8")
                    best[: len(x)] += x
                    total[: len(y)] += y
        yield from done()

    documents = runs.filter(F.col("radix") == -1).select("slice", "rows", F.lit(None).cast("binary").alias("sums"))
    parts = sums.select("slice", F.lit(None).cast(documents.schema["rows"].dataType).alias("rows"), "sums")
    return documents.unionByName(parts).repartition("slice").sortWithinPartitions("slice", F.col("rows").isNull()).mapInArrow(run, from_arrow_schema(schema))
