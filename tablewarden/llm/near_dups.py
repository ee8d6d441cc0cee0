"""MinHash near-duplicate detection with sequential Bayesian verification.

1. Texts of equal shingle sets are one class; from here on only classes are compared, so copies cost nothing.
2. Signatures of HASHES minima are cut into bands of ROWS; classes that share a band are candidates.
3. In each bucket all classes are compared with its leader. A comparison reads the signatures in batches of BATCH
   and stops as soon as the posterior (uniform prior, so a Beta) puts the chance of a similarity over the
   threshold below MISS. Survivors are confirmed on their full shingle sets: first the best of each class, then
   those that the links found so far do not join already. The leader is then done with.
4. Links give components. Only buckets that still hold several are looked at again: every class outside a bucket's
   largest component meets the others in blocks. First, the beginnings of signatures tell which classes have any
   pair to look at. Of those, a shingle that no other has cannot be shared, so classes with too many of them leave
   (again and again, as others' shingles become their own). What is left meets with sizes, signatures and sets, and a
   block gives back only the links that join components.

A pair at the threshold shares no band with probability (1 - 0.8**ROWS)**(HASHES/ROWS), 5e-8 here.

Nulls: a null or empty text, or one without words, has no shingles and is linked with nothing; its component
is its own doc_id. Rows with a null doc_id take part; a component's id is its smallest id that is not null, and
null if it has none. Equal rows are copies of each other. Very long texts are read whole; a signature stays of one
size. Ties: of equally similar leaders the one of the larger number comes first, which changes no result. Empty
tables give empty tables. doc_id is an integer.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, map_rows, mix, scratch, word_hashes

HASHES, ROWS, BATCH = 128, 4, 32
#: Chance that a pair at the threshold is pruned in one comparison of a batch.
MISS = 1e-7
#: Classes on one side of a block of a bucket, and shingles of them (8 classes, at least).
BLOCK, HELD = 1024, 1 << 22
#: Hashes of a signature by which classes of an open bucket are told to meet at all.
PREFIX = 64
#: Times that classes without enough shared shingles are looked for; what is left afterwards is compared.
PEELS = 6
#: Bytes of rows under which one side of a join is sent to all tasks.
SMALL = 8 << 20

_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of `size` words; a shorter text is one shingle of all its words."""
    w = word_hashes(text.encode())
    if not len(w):
        return w
    size = min(size, len(w))
    h = w[: len(w) - size + 1]
    for k in range(1, size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - size + 1 + k])
    return np.unique(h)


def signature(h: np.ndarray) -> np.ndarray:
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        y = (x[at : at + 2048, None] ^ _XOR) * _MUL
        y ^= y >> np.uint32(15)
        np.minimum(out, y.min(0), out=out)
    return out


def fewest_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes read, matches needed) after each batch: fewer put P(similarity >= threshold) under miss.

    With a uniform prior, k matches of m give Beta(k + 1, m - k + 1), whose upper tail at t is P(Binomial(m + 1, t) <= k).
    """
    out = []
    for m in range(BATCH, HASHES + 1, BATCH):
        tail, k = 0.0, -1
        while tail < miss:
            k += 1
            tail += math.comb(m + 1, k) * threshold**k * (1 - threshold) ** (m + 1 - k)
        out.append((m, k))
    return out


def survive(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of the signature matrices a, b get through all batches."""
    alive, seen, read = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for m, need in bounds:
        seen[alive] += (a[alive, read:m] == b[alive, read:m]).sum(1)
        alive, read = alive[seen[alive] >= need], m
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, class (of the shingle set; null without shingles), n_shingles, signature of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("class", pa.binary()), ("n_shingles", pa.int64()), ("signature", pa.binary())])

    def make():
        def step(c):
            sets = [shingles(t, size) for t in c["text"]]
            return {
                "doc_id": c["doc_id"],
                "text_hash": c["text_hash"],
                "class": [digest(s) if len(s) else None for s in sets],
                "n_shingles": list(map(len, sets)),
                "signature": [signature(s).tobytes() if len(s) else None for s in sets],
            }

        return step

    return map_rows(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), make, schema)


def pruned(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """a, b of the pairs that the signatures do not rule out, each with its share of equal minima."""
    sig = classes.select("id", "signature")
    rows = pairs.join(sig.withColumnsRenamed({"id": "a", "signature": "sa"}), "a").join(sig.withColumnsRenamed({"id": "b", "signature": "sb"}), "b")
    bounds = fewest_matches(threshold)

    def make():
        def step(c):
            a, b = (np.frombuffer(b"".join(c[k]), np.uint32).reshape(-1, HASHES) for k in ("sa", "sb"))
            keep = survive(a, b, bounds)
            share = (a[keep] == b[keep]).mean(1)
            return {k: np.array(c[k], np.int64)[keep] for k in ("a", "b")} | {"share": share}

        return step

    return map_rows(rows.select("a", "b", "sa", "sb"), make, PAIRS, rows=2048)


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("share", pa.float64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def texts_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """id, class, text of the classes with these ids; a text of another class but of the same 64-bit hash may be among them."""
    wanted = scratch(ids.distinct().join(classes.select("id", "class", "text_hash"), "id"), "wanted")
    hashes = wanted.select("text_hash").distinct()
    if wanted.count() * 16 <= SMALL:
        hashes = F.broadcast(hashes)
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(hashes, "text_hash", "left_semi").dropDuplicates(["text_hash", "text"])
    return scratch(texts.join(wanted, "text_hash").select("id", "class", "text"), "texts")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """a, b of the pairs whose full sets reach the threshold. Texts are moved, not sets: they are smaller."""
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), classes, docs)
    one = lambda k: texts.select(F.col("id").alias(k), F.col("class").alias(f"c{k}"), F.col("text").alias(f"t{k}"))
    # leaders last: their texts are put to rows that stand by leader, and are not moved with each of them
    both = pairs.select("a", "b").join(one("b"), "b").join(one("a"), "a")
    percent = round(threshold * 100)

    def check():
        last: list = [None, None]

        def set_of(text: str) -> np.ndarray:
            if last[0] != text:  # the rows of one leader stand together
                last[:] = [text, shingles(text, size)]
            return last[1]

        def step(c):
            keep = []
            for ta, tb, ca, cb in zip(c["ta"], c["tb"], c["ca"], c["cb"], strict=True):
                x, y = set_of(ta), shingles(tb, size)
                common = len(np.intersect1d(x, y, assume_unique=True))
                # two texts of one 64-bit hash: only the class's own counts
                keep.append(100 * common >= percent * (len(x) + len(y) - common) and digest(x) == ca and digest(y) == cb)
            keep = np.array(keep, bool)
            return {k: np.array(c[k], np.int64)[keep] for k in ("a", "b")}

        return step

    return map_rows(both.select("a", "b", "ta", "tb", "ca", "cb"), check, LINKS, rows=256)


def components(links: DataFrame) -> DataFrame:
    """id, component of all classes with links: each takes the smallest id among its own and its neighbours', then that one's own; until nothing changes."""
    edges = scratch(links.select(F.col("a").alias("id"), F.col("b").alias("near")).union(links.select("b", "a")).filter("id <> near").distinct(), "edges")
    state = scratch(edges.groupBy("id").agg(F.min("near").alias("m")).select("id", F.least("id", "m").alias("component")), "state")
    while True:
        names = state.select(F.col("id").alias("component"), F.col("component").alias("next"))
        jumped = state.join(names, "component").select("id", F.col("component").alias("before"), F.col("next").alias("component"))
        near = edges.join(jumped.select(F.col("id").alias("near"), F.col("component").alias("other")), "near").groupBy("id").agg(F.min("other").alias("other"))
        new = scratch(jumped.join(near, "id").select("id", "before", F.least("component", "other").alias("component")), "jumped")
        if not new.filter("component <> before").limit(1).count():
            return state
        state = new.select("id", "component")


def apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs a, b whose classes are not in one component yet."""
    of = lambda k: parts.select(F.col("id").alias(k), F.col("component").alias(f"part_{k}"))
    named = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return named.filter(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select(*pairs.columns)


def still_open(rows: DataFrame, name: str) -> DataFrame:
    """key, band, id, component of the buckets that hold several components."""
    several = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    return scratch(rows.join(several, "key"), name)


def shingle_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """id, n, shingles (array of 64-bit hashes) of the classes with these ids."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def make():
        def step(c):
            found = [(k, s.view(np.int64)) for k, name, s in zip(c["id"], c["class"], (shingles(t, size) for t in c["text"]), strict=True) if digest(s) == name]
            return {"id": [k for k, _ in found], "n": [len(s) for _, s in found], "shingles": [s for _, s in found]}

        return step

    return scratch(map_rows(texts_of(ids, classes, docs), make, schema, rows=256), "sets")


def peeled(rows: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """rows of open buckets without the classes that cannot reach the threshold with any other, and id, n, own of those that stay.

    own: shingles that no other class of the open buckets has; a similarity is at most the share of the others.
    """
    percent = round(threshold * 100)
    held, places = sets, None
    for _ in range(PEELS):
        lone = held.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("m"), F.min("id").alias("id")).filter("m = 1")
        sizes = held.select("id", "n").join(lone.groupBy("id").agg(F.count("*").alias("own")), "id", "left").fillna(0, ["own"])
        sizes = scratch(sizes, "sizes")
        hopeful = sizes.filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")).select("id")
        before, after = sizes.count(), hopeful.count()
        if before == after:
            break
        held, places = sets.join(hopeful, "id", "left_semi"), hopeful
    if places is not None:
        # a row a class is joined, not one for each of its bands; written, or Spark moves the join below the grouping
        classes = scratch(rows.groupBy("id").agg(F.first("component").alias("component"), F.collect_list(F.struct("key", "band")).alias("_at")), "places")
        stay = classes.join(places, "id", "left_semi").select("id", "component", F.explode("_at").alias("_at"))
        rows = still_open(stay.select("_at.key", "_at.band", "id", "component"), "peeled")
    return rows, sizes


def grid(rows: DataFrame, longest: Column) -> DataFrame:
    """rows (key, id, component, ...) of each bucket as a grid: the classes outside its largest component (asks) against all.

    Rows that are copied: those that ask once for every block of all, the others once for every block of those that
    ask. A block holds BLOCK classes on a side, fewer where `longest` of them would exceed HELD. Adds main, i, j, asks.
    """
    counts = rows.groupBy("key", "component").agg(F.count("*").alias("m"), F.max(longest).alias("longest"))
    counts = counts.groupBy("key").agg(
        F.max_by("component", F.struct("m", "component")).alias("main"),
        F.sum("m").alias("all"),
        (F.sum("m") - F.max("m")).alias("outside"),
        F.greatest(F.lit(8), F.least(F.lit(BLOCK), F.floor(HELD / F.max("longest")))).alias("per"),
    )
    own = rows.columns
    rows = rows.join(scratch(counts, "counts"), "key").withColumn("main", F.col("component") == F.col("main"))
    part = lambda n: F.ceil(F.col(n) / F.col("per")).cast("int")
    place = lambda n: F.pmod(F.xxhash64("id", F.lit(1)), part(n)).cast("int")
    one = rows.select(*own, "main", F.explode(F.sequence(F.lit(0), part("outside") - 1)).alias("i"), place("all").alias("j"), F.lit(False).alias("asks"))
    two = rows.filter("not main").select(*own, "main", place("outside").alias("i"), F.explode(F.sequence(F.lit(0), part("all") - 1)).alias("j"), F.lit(True).alias("asks"))
    return one.unionByName(two)


def asked(table: pa.Table, hashes: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Columns and signatures of a block, and the places of the rows that do not ask."""
    c = {n: table.column(n).to_numpy(zero_copy_only=False) for n in table.column_names if n not in ("signature", "shingles")}
    return c, np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, hashes), np.flatnonzero(~c["asks"])


def met(rows: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """rows (key, band, id, component) of those classes that a class of another component of the bucket may be like, by the first PREFIX hashes."""
    from pyspark.sql.pandas.types import from_arrow_schema

    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])
    bounds = [b for b in fewest_matches(threshold) if b[0] <= PREFIX]
    sketch = classes.select("id", F.substring("signature", 1, 4 * PREFIX).alias("signature"))

    def alive(table: pa.Table) -> pa.Table:
        c, sig, others = asked(table, PREFIX)
        found = np.zeros(len(sig), bool)
        for x in np.flatnonzero(c["asks"]):
            y = others[(c["component"][others] != c["component"][x]) & (c["main"][others] | (c["id"][others] > c["id"][x]))]
            y = y[survive(np.broadcast_to(sig[x], (len(y), PREFIX)), sig[y], bounds)]
            found[y] = True
            found[x] |= len(y) > 0
        ids = np.unique(c["id"][found])
        return pa.table([pa.array(np.full(len(ids), c["key"][0])), pa.array(ids)], schema=schema)

    cells = grid(rows, F.lit(PREFIX)).select("key", "id", "component", "main", "i", "j", "asks")
    found = cells.join(sketch, "id").groupBy("key", "i", "j").applyInArrow(alive, from_arrow_schema(schema)).distinct()
    return still_open(rows.join(scratch(found, "met"), ["key", "id"], "left_semi"), "meeting")


def block_links(rows: DataFrame, sizes: DataFrame, sets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """a, b of links between different components of a bucket, as many as join them.

    A pair that sizes and signatures do not rule out is confirmed in its block on its sets, in the first band that it
    shares, unless links of the block join it already.
    """
    from pyspark.sql.pandas.types import from_arrow_schema

    cells = grid(rows.join(sizes, "id"), F.col("n")).select("key", "band", "id", "component", "own", "main", "i", "j", "asks")
    full = sets.select("id", "shingles").join(classes.select("id", "signature"), "id")
    bounds, percent = fewest_matches(threshold), round(threshold * 100)

    def links(table: pa.Table) -> pa.Table:
        c, sig, others = asked(table, HASHES)
        held = table.column("shingles").combine_chunks()
        at, flat, band = held.offsets.to_numpy(), held.values.to_numpy(), c["band"][0]
        ids, part, n = c["id"], c["component"].copy(), np.diff(at)
        shared, out = n - c["own"], []
        for x in np.flatnonzero(c["asks"]):
            mine = np.sort(flat[at[x] : at[x + 1]])
            y = others[(part[others] != part[x]) & (c["main"][others] | (ids[others] > ids[x]))]
            # what both can share, against the least that they have together
            y = y[100 * np.minimum(shared[y], shared[x]) >= percent * (c["own"][y] + c["own"][x] + np.maximum(shared[y], shared[x]))]
            y = y[survive(np.broadcast_to(sig[x], (len(y), HASHES)), sig[y], bounds)]
            y = y[(sig[y] == sig[x]).reshape(len(y), HASHES // ROWS, ROWS).all(2).argmax(1) == band]
            for some in np.array_split(y, -(-len(y) // 64)) if len(y) else []:
                some = some[part[some] != part[x]]
                if not len(some):
                    continue
                cat = np.concatenate([flat[at[k] : at[k + 1]] for k in some])
                hit = mine[np.minimum(np.searchsorted(mine, cat), len(mine) - 1)] == cat
                common = np.add.reduceat(hit.astype(np.int64), np.cumsum(n[some]) - n[some])
                for k in some[100 * common >= percent * (n[x] + n[some] - common)]:
                    if part[k] != part[x]:
                        out.append((int(ids[x]), int(ids[k])))
                        part[part == part[k]] = part[x]
        cols = list(zip(*out, strict=True)) or [()] * 2
        if len(sig) > BLOCK // 2:  # a large block's memory goes back at once
            give_back()
        return pa.table([pa.array(list(v), f.type) for v, f in zip(cols, LINKS, strict=True)], schema=LINKS)

    return cells.join(full, "id").groupBy("key", "i", "j").applyInArrow(links, from_arrow_schema(LINKS))


def unsettled(bands: DataFrame, parts: DataFrame, classes: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame | None:
    """Links (a, b) that join components once the buckets, without their leaders, have been looked at again; None if nothing is open."""
    rows = still_open(bands.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id")), "open")
    if not rows.limit(1).count():
        return None
    rows = met(rows, classes, threshold)
    if not rows.limit(1).count():
        return None
    sets = shingle_sets(rows.select("id"), classes, docs, size)
    rows, sizes = peeled(rows, sets, threshold)
    return scratch(block_links(rows, sizes, sets, classes, threshold), "more") if rows.limit(1).count() else None


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of every row: components of the links of similarity >= threshold on runs of `size` words."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = scratch(sketch(docs, size), "sketch")
    classes = rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"), F.first("signature").alias("signature"))
    classes = scratch(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # written, so the ids stay
    n_bands, width = HASHES // ROWS, 4 * ROWS
    key: Column = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * width + 1, F.lit(width))))
    bands = classes.select("id", F.posexplode(key).alias("band", "key"))
    leaders = scratch(bands.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a"), "leaders")
    shared = scratch(bands.join(leaders, "key"), "shared")
    star = shared.filter("a <> id").select("a", F.col("id").alias("b")).distinct()
    candidates = scratch(pruned(star, classes, threshold), "candidates")
    best = scratch(candidates.groupBy("b").agg(F.max_by("a", F.struct("share", "a")).alias("a")).select("a", "b"), "best")
    links = scratch(confirmed(best, classes, docs, size, threshold), "links")
    parts = components(links)
    rest = scratch(apart(candidates.select("a", "b").join(best, ["a", "b"], "left_anti"), parts), "rest")
    if rest.limit(1).count():
        links = scratch(links.union(confirmed(rest, classes, docs, size, threshold)), "all_links")
        parts = components(links)
    # a leader has met all of its bucket; the others meet where they are in different components
    others = shared.filter("a <> id").select("key", "band", "id")
    more = unsettled(others, parts, classes, docs, size, threshold)
    if more is not None and more.limit(1).count():
        parts = components(links.union(more))
    ids = parts.join(classes.select("id", "doc_id"), "id")
    ids = ids.join(ids.groupBy("component").agg(F.min("doc_id").alias("linked")), "component").select("id", "linked")
    named = classes.select("class", "id", "doc_id").join(ids, "id", "left").select("class", F.coalesce("linked", "doc_id").alias("component_id"))
    out = rows.select("doc_id", "text_hash", "n_shingles", "class").join(named, "class", "left")
    return out.select("doc_id", "text_hash", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of docs, all columns, that stand for their component; of equal rows one stays."""
    found = near_duplicates(docs, size, threshold)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_hash").distinct()
    key, doc, text_hash = (fresh(docs, n) for n in ("text_key", "kept_id", "kept_hash"))
    kept = kept.withColumnsRenamed({"doc_id": doc, "text_hash": text_hash})
    own = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = own.join(kept, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(text_hash)), "left_semi")
    return rows.dropDuplicates(["doc_id", key]).drop(key)
