"""Nearest vectors, exact and through an index."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder, ship
from . import vector_index


def check_vector(v: Sequence[float]) -> list[float]:
    if not len(v) or not all(math.isfinite(x) for x in v):
        raise ValueError("a vector must have entries, all finite")
    return [float(x) for x in v]


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column, b: Column, kind: str) -> Column:
    """cosine (1 - similarity), l2, or inner (negated, so that smaller is nearer for all three)."""
    match kind:
        case "cosine":
            return 1 - _dot(a, b) / F.sqrt(_dot(a, a) * _dot(b, b))
        case "l2":
            return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))
        case "inner":
            return -_dot(a, b)
    raise ValueError(f"unknown distance: {kind}")


def nearest(df: DataFrame, query: Sequence[float], vector: str, key: str, k: int = 10, kind: str = "cosine", where: str | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """The k rows nearest to one vector: a top-k without a full sort; ties by key."""
    q = F.array(*[F.lit(x) for x in check_vector(query)])
    rows = df.filter(where) if where else df
    return rows.select(key, *columns, distance(F.col(vector), q, kind).alias("distance")).orderBy("distance", key).limit(k)


def _blocks(df: DataFrame, vector: str, key: str, size: int, name: str) -> DataFrame:
    """Rows of `size` vectors: their keys and one matrix."""
    import pandas as pd

    def pack(frames):
        for f in frames:
            for at in range(0, len(f), size):
                part = f.iloc[at : at + size]
                x = np.stack([np.asarray(v, float) for v in part[vector]])
                if not x.size or not np.isfinite(x).all():
                    raise ValueError("a vector must have entries, all finite")
                yield pd.DataFrame({f"{name}_keys": [part[key].tolist()], f"{name}_data": [x.astype("<f8").tobytes()]})

    return df.select(key, vector).mapInPandas(pack, f"{name}_keys array<long>, {name}_data binary")


#: Bytes of query vectors that are sent to all tasks; more of them meet the rows in blocks.
SENT = 32 << 20


def _distances(q: np.ndarray, x: np.ndarray, kind: str) -> np.ndarray:
    if kind == "l2":
        return np.sqrt(np.maximum((q**2).sum(1)[:, None] + (x**2).sum(1) - 2 * q @ x.T, 0))
    d = -(q @ x.T)
    return 1 + d / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)) if kind == "cosine" else d


def _best(d: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k least distances of each row, ties by key, and their keys."""
    order = np.lexsort((keys, d), axis=1)[:, :k]
    return np.take_along_axis(d, order, 1), np.take_along_axis(keys, order, 1)


def nearest_each(df: DataFrame, queries: DataFrame, vector: str, key: str, k: int = 10, kind: str = "cosine", block: int = 256, rows: int = 4096, sent: int = SENT) -> DataFrame:
    """query, key, distance, rank of the k nearest rows to each query vector (itself left out).

    Queries of `sent` bytes at most, as counted first, go to all tasks; each task keeps k rows a query over all that it reads,
    and only those are shuffled. More queries meet the rows in blocks, and k rows a query are left of each meeting.
    """
    w = Window.partitionBy("query").orderBy("distance", key)
    ranked = lambda found: found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    size = queries.agg(F.coalesce(F.sum(F.size(vector)), F.lit(0)).alias("n")).first()["n"] * 8
    if size > sent:
        return ranked(_in_blocks(df, queries, vector, key, k, kind, block, rows))
    own = queries.select(key, vector).orderBy(key).collect()
    if not own:
        return ranked(_in_blocks(df, queries, vector, key, k, kind, block, rows))
    who, q = np.array([r[key] for r in own]), np.array([check_vector(r[vector]) for r in own])

    def scan(frames):
        import pandas as pd

        best = np.full((len(who), 0), np.inf)
        near = np.zeros((len(who), 0), np.int64)
        for f in frames:
            for at in range(0, len(f), rows):
                part = f.iloc[at : at + rows]
                x, keys = np.stack([np.asarray(v, float) for v in part[vector]]), part[key].to_numpy(np.int64)
                if not x.size or not np.isfinite(x).all():
                    raise ValueError("a vector must have entries, all finite")
                for lo in range(0, len(who), block):
                    hi = min(lo + block, len(who))
                    if lo == 0:
                        wide = np.full((len(who), best.shape[1] + min(k, len(x))), np.inf)
                        names = np.zeros(wide.shape, np.int64)
                    d = _distances(q[lo:hi], x, kind)
                    d[who[lo:hi, None] == keys] = np.inf
                    m = min(k, len(x))
                    edge = np.partition(d, m - 1, axis=1)[:, m - 1 : m]
                    for i in range(hi - lo):  # all ties at the edge, then the least keys
                        j = np.flatnonzero(d[i] <= edge[i])
                        j = j[np.lexsort((keys[j], d[i, j]))[:m]]
                        wide[lo + i, best.shape[1] : best.shape[1] + len(j)] = d[i, j]
                        names[lo + i, best.shape[1] : best.shape[1] + len(j)] = keys[j]
                wide[:, : best.shape[1]], names[:, : best.shape[1]] = best, near
                best, near = _best(wide, names, k)
        i, j = np.nonzero(np.isfinite(best))
        yield pd.DataFrame({"query": who[i], key: near[i, j], "distance": best[i, j]})

    ship(df.sparkSession)
    return ranked(df.select(key, vector).mapInPandas(scan, f"query long, {key} long, distance double"))


def _in_blocks(df: DataFrame, queries: DataFrame, vector: str, key: str, k: int, kind: str, block: int, rows: int) -> DataFrame:
    import pandas as pd

    def scan(frames):
        for f in frames:
            for qk, qd, dk, dd in zip(f["q_keys"], f["q_data"], f["d_keys"], f["d_data"], strict=True):
                qk, dk = np.asarray(qk), np.asarray(dk)
                q, x = np.frombuffer(qd, "<f8").reshape(len(qk), -1), np.frombuffer(dd, "<f8").reshape(len(dk), -1)
                d = _distances(q, x, kind)
                d[qk[:, None] == dk] = np.inf
                best, near = _best(d, np.broadcast_to(dk, d.shape), k)
                i, j = np.nonzero(np.isfinite(best))
                yield pd.DataFrame({"query": qk[i], key: near[i, j], "distance": best[i, j]})

    ship(df.sparkSession)
    pairs = _blocks(df, vector, key, rows, "d").crossJoin(_blocks(queries, vector, key, block, "q"))
    return pairs.mapInPandas(scan, f"query long, {key} long, distance double")


def approximate_nearest(df: DataFrame, queries: DataFrame, vector: str, key: str, k: int = 10, bucket: int | None = None, recall: float = 0.95) -> DataFrame:
    """query, key, distance, rank by cosine, over an index that is made for this search and left in the shared folder.

    See vector_index: every row is in one list, queries meet blocks of the lists that they probe, and k rows a query leave a block,
    so no pair is ever a row. bucket: rows of a list, about; unless given lists grow as the root of the rows.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    lists = min(vector_index.LISTS, max(1, math.ceil(df.count() / bucket))) if bucket else None
    vector_index.build_index(df, vector, key, path, "cosine", lists, k, recall)
    return vector_index.search_index(df.sparkSession, path, queries, vector, key, k)
