"""A kept index of vectors: inverted lists under trained centroids, product codes inside them.

build_index fits centroids and codebooks on a bounded sample (SAMPLE rows at most, by hash of the key), then puts every row into
the list of its nearest centroid and writes lists as partitions of a table, in blocks of BLOCK vectors: keys, codes, vectors.
search_index reads only the partitions of the lists that its queries probe; in a block, distance tables over the codes choose
the candidates, whose distances are then computed from the vectors. How many lists are probed is measured at the build: as
many as the sample's own rows need for the wanted recall of their neighbours in the sample.

Blocks of a list meet blocks of the queries that probe it; of each meeting k rows a query are left. Large lists are
many blocks, which adaptive execution deals out. A vector that is null, of another length, or not finite raises. Ties by key.
An empty table makes an index without lists, which finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship

#: Rows that centroids and codebooks are fitted on, lists, vectors of a block, queries of a block.
SAMPLE, LISTS, BLOCK, ASKED = 20_000, 4096, 2048, 128
#: Entries of a code's part, centroids of a part, rounds of fitting.
WIDTH, CODES, ROUNDS = 8, 256, 12


def _matrix(vectors, kind: str, size: int | None = None) -> np.ndarray:
    if any(v is None for v in vectors):
        raise ValueError("a vector must have entries, all finite")
    x = np.stack([np.asarray(v, float) for v in vectors])
    if not x.size or not np.isfinite(x).all() or (size is not None and x.shape[1] != size):
        raise ValueError("a vector must have entries, all finite, and all the same number of them")
    return x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None] if kind == "cosine" else x


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (c**2).sum(1) - 2 * x @ c.T, 0)


def _centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; a centre without rows takes the row that is farthest from its own."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        d = _squares(x, c)
        near = d.argmin(1)
        sums, sizes = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
        empty = np.flatnonzero(sizes == 0)
        c[empty] = x[np.argsort(-d[np.arange(len(x)), near])[: len(empty)]]
    return c


def _parts(x: np.ndarray) -> list[np.ndarray]:
    return [x[:, i : i + WIDTH] for i in range(0, x.shape[1], WIDTH)]


def _probes(x: np.ndarray, c: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> int:
    """Lists that rows of the sample must probe for so much of their k nearest in the sample."""
    asked = rng.choice(len(x), min(200, len(x)), replace=False)
    d = _squares(x[asked], x)
    d[np.arange(len(asked)), asked] = np.inf
    near = np.argsort(d, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    own = _squares(x, c).argmin(1)
    rank = np.argsort(np.argsort(_squares(x[asked], c), axis=1, kind="stable"), axis=1)
    place = np.sort(np.take_along_axis(rank, own[near], 1).ravel())
    return int(place[min(len(place) - 1, int(np.ceil(recall * len(place))))]) + 1 if len(place) else 1


def build_index(df: DataFrame, vector: str, key: str, path: str, kind: str = "cosine", lists: int | None = None, k: int = 10, recall: float = 0.95, sample: int = SAMPLE, seed: int = 3) -> None:
    """Write the index of df's vectors (kind: cosine or l2) as tables `lists`, `sizes` and `model` under path. key is an integer."""
    if kind not in ("cosine", "l2"):
        raise ValueError(f"unknown distance: {kind}")
    spark = df.sparkSession
    ship(spark)
    n = df.count()
    share = min(1.0, 1.2 * sample / max(n, 1))
    first = df.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(np.ceil(share * 1_000_000))).select(key, vector).limit(sample).orderBy(key).collect()
    rng = np.random.default_rng(seed)
    x = _matrix([r[vector] for r in first], kind) if first else np.zeros((0, 1))
    centres = _centres(x, lists or min(LISTS, max(1, round(n**0.5))), rng) if len(x) else np.zeros((0, 1))
    rest = x - centres[_squares(x, centres).argmin(1)] if len(x) else x
    books = [_centres(p, min(CODES, len(p)), rng) for p in _parts(rest)] if len(x) else []
    probes = _probes(x, centres, k, recall, rng) if len(x) else 0
    size = x.shape[1]

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield pd.DataFrame({"list": _squares(_matrix(f[vector], kind, size), centres).argmin(1).astype("int32"), "key": f[key], "vector": f[vector]})

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of the rows of a list, which come one after the other."""

        def block(number: int, rows: pd.DataFrame) -> pd.DataFrame:
            y = _matrix(rows["vector"], kind, size)
            codes = np.stack([_squares(p, b).argmin(1) for p, b in zip(_parts(y - centres[number]), books, strict=True)], axis=1).astype("u1")
            return pd.DataFrame({"list": [np.int32(number)], "n": [len(rows)], "keys": [rows["key"].to_numpy("<i8").tobytes()], "codes": [codes.tobytes()], "vectors": [y.astype("<f8").tobytes()]})

        wait: list[pd.DataFrame] = []
        now = None
        for f in frames:
            for number, rows in f.groupby("list", sort=False):
                if number != now and wait:
                    yield block(now, pd.concat(wait))
                    wait = []
                now = number
                rows = pd.concat([*wait, rows])
                for at in range(0, len(rows) - BLOCK + 1, BLOCK):
                    yield block(number, rows.iloc[at : at + BLOCK])
                wait = [rows.iloc[len(rows) // BLOCK * BLOCK :]]
                wait = [w for w in wait if len(w)]
        if wait:
            yield block(now, pd.concat(wait))

    own = df.select(key, vector).mapInPandas(assign, "list int, key long, vector array<double>")
    # a list of many rows goes to as many tasks as it has salts
    own = own.repartition("list", F.pmod(F.xxhash64("key"), F.lit(16))).sortWithinPartitions("list", "key")
    own.mapInPandas(pack, "list int, n long, keys binary, codes binary, vectors binary").write.partitionBy("list").mode("overwrite").parquet(f"{path}/lists")
    model = [(kind, size, probes, n, [c.tolist() for c in centres], [[e.tolist() for e in b] for b in books])]
    spark.createDataFrame(model, "kind string, size int, probes int, rows long, centres array<array<double>>, books array<array<array<double>>>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    if n:
        spark.read.parquet(f"{path}/lists").groupBy("list").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{path}/sizes")


def _model(spark: SparkSession, path: str):
    m = spark.read.parquet(f"{path}/model").first()  # one row: centroids and codebooks, bounded by LISTS and CODES
    return m["kind"], m["size"], m["probes"], m["rows"], np.array(m["centres"], float), [np.array(b, float) for b in m["books"]]


def probed(spark: SparkSession, path: str, queries: DataFrame, vector: str, key: str, probes: int | None = None, least: int = 40) -> DataFrame:
    """query, list, vector: the lists that each query probes, nearest first: `probes` of them, and on until they hold `least` rows."""
    ship(spark)
    kind, size, default, _, centres, _ = _model(spark, path)
    most = min(len(centres), probes or default)
    sizes = np.zeros(len(centres), np.int64)
    if most:
        for r in spark.read.parquet(f"{path}/sizes").collect():  # LISTS rows at most
            sizes[r["list"]] = r["n"]

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f) and most:
                q = _matrix(f[vector], kind, size)
                near = np.argsort(_squares(q, centres), axis=1, kind="stable")
                before = np.cumsum(sizes[near], axis=1) - sizes[near]
                i, j = np.nonzero((np.arange(len(centres)) < most) | (before < least))
                yield pd.DataFrame({"query": f[key].to_numpy()[i], "list": near[i, j].astype("int32"), "vector": [q[x].tolist() for x in i]})

    return queries.select(key, vector).mapInPandas(ask, "query long, list int, vector array<double>")


def search_index(spark: SparkSession, path: str, queries: DataFrame, vector: str, key: str, k: int = 10, probes: int | None = None, rerank: int = 8) -> DataFrame:
    """query, the key's name, distance, rank of the k nearest rows (a query's own key left out): of a block the rerank * k best by code are compared."""
    kind, _, _, _, centres, books = _model(spark, path)
    asked = probed(spark, path, queries, vector, key, probes, 4 * k)
    result = f"query long, {key} long, distance double"
    if not len(centres):
        return spark.createDataFrame([], result + ", rank int")

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for number, rows in f.groupby("list", sort=False):
                for at in range(0, len(rows), ASKED):
                    part = rows.iloc[at : at + ASKED]
                    yield pd.DataFrame({"list": [number], "asked": [part["query"].to_numpy("<i8").tobytes()], "points": [np.stack(part["vector"]).astype("<f8").tobytes()]})

    blocks = asked.repartition("list").sortWithinPartitions("list").mapInPandas(gather, "list int, asked binary, points binary")
    wanted = [r["list"] for r in asked.select("list").distinct().collect()]  # LISTS at most
    table = spark.read.parquet(f"{path}/lists").filter(F.col("list").isin(wanted))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for number, keys, codes, data, who, points in zip(f["list"], f["keys"], f["codes"], f["vectors"], f["asked"], f["points"], strict=True):
                keys, who = np.frombuffer(keys, "<i8"), np.frombuffer(who, "<i8")
                x, q = np.frombuffer(data, "<f8").reshape(len(keys), -1), np.frombuffer(points, "<f8").reshape(len(who), -1)
                codes = np.frombuffer(codes, "u1").reshape(len(keys), -1)
                most = min(len(keys), rerank * k + 1)
                about = np.zeros((len(who), len(keys)))
                for j, (p, b) in enumerate(zip(_parts(q - centres[number]), books, strict=True)):
                    about += _squares(p, b)[:, codes[:, j]]
                near = np.argpartition(about, most - 1, axis=1)[:, :most]
                exact = 1 - np.einsum("ij,ikj->ik", q, x[near]) if kind == "cosine" else np.sqrt(((x[near] - q[:, None]) ** 2).sum(2))
                exact[keys[near] == who[:, None]] = np.inf
                best = np.lexsort((keys[near], exact), axis=1)[:, :k]
                d = np.take_along_axis(exact, best, 1)
                i, j = np.nonzero(np.isfinite(d))
                yield pd.DataFrame({"query": who[i], key: keys[np.take_along_axis(near, best, 1)[i, j]], "distance": d[i, j]})

    found = table.join(blocks, "list").select("list", "keys", "codes", "vectors", "asked", "points").mapInPandas(scan, result)
    w = Window.partitionBy("query").orderBy("distance", key)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rows_read(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """query, rows_read, rows: rows in the lists that each query probes, and in the index."""
    total = _model(spark, path)[3]
    return asked.join(spark.read.parquet(f"{path}/sizes"), "list").groupBy("query").agg(F.sum("n").alias("rows_read")).withColumn("rows", F.lit(total))

