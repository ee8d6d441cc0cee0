"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word has a sparse random index vector, made from its hash. A word's context vector sums the index
vectors of its neighbours over the whole corpus; words share BUCKETS rows, so the table is of one size for
every corpus. A document is pooled into the mean and spread of its words' vectors. The network's
probabilities are divided by a temperature that held-back teachers choose.

Nulls: a null text is the empty text (all features 0). Without teachers, or with one kind only, every score is
the share of label 1 among them (0.5 without any). Empty tables give empty tables. Rows of equal doc_id are
scored each for itself, equal texts alike; labels, lang and source never enter a score. Very long texts are pooled
whole. doc_id is an integer.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prefix_hash, ship, span_hash
from .labelled import SAMPLE, Scorer, fit, teachers
from .models import Network

BUCKETS, DIM, NEAR = 16_384, 48, 2
#: Rows of the table that travel together, and partial sums that a block's first round is spread over.
BLOCK, SALTS = 128, 16

_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def tokens(text: str) -> np.ndarray:
    """Buckets of a text's runs of letters and digits, and of its runs of other signs; case counts."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    cut = np.flatnonzero(np.diff(kind)) + 1
    starts = np.concatenate(([0], cut))
    ends = np.concatenate((cut, [len(data)]))
    solid = kind[starts] > 0
    return (span_hash(prefix_hash(data), starts[solid], ends[solid]) % np.uint64(BUCKETS)).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two places and signs of every bucket's index vector."""
    rng = np.random.default_rng(11)
    return rng.integers(0, DIM, (BUCKETS, 2)), rng.choice([-1.0, 1.0], (BUCKETS, 2))


def context_vectors(df: DataFrame) -> np.ndarray:
    """The BUCKETS x DIM table of context sums over all of df's texts."""
    from pyspark.sql.pandas.types import from_arrow_schema

    schema = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("part", pa.binary())])

    def sums(batches):
        from pyspark import TaskContext

        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIM)
        seen = False
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                ids: list[np.ndarray] = []
                for t in batch.slice(at, 512).column(0).to_pylist():
                    ids += [tokens(t or ""), np.full(NEAR, -1)]
                w = np.concatenate(ids) if ids else np.zeros(0, np.int64)
                for gap in range(1, NEAR + 1):
                    a, b = w[:-gap], w[gap:]
                    ok = (a >= 0) & (b >= 0)
                    a, b = a[ok], b[ok]
                    seen = seen or len(a) > 0
                    for k in range(2):
                        total += np.bincount(a * DIM + places[b, k], signs[b, k], BUCKETS * DIM)
                        total += np.bincount(b * DIM + places[a, k], signs[a, k], BUCKETS * DIM)
        if seen:
            salt = TaskContext.get().partitionId() % SALTS
            blocks = total.reshape(-1, BLOCK * DIM)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([salt] * len(blocks), pa.int32()), pa.array([b.tobytes() for b in blocks])], schema=schema)

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = np.frombuffer(part)
                held[block] = held[block] + x if block in held else x
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([*held], pa.int32()), pa.array([0] * len(held), pa.int32()), pa.array([v.tobytes() for v in held.values()])], schema=schema)

    ship(df.sparkSession)
    spark_schema = from_arrow_schema(schema)
    part = df.select("text").mapInArrow(sums, spark_schema)
    part = part.repartition("block", "salt").mapInArrow(add, spark_schema)
    part = part.repartition("block").mapInArrow(add, spark_schema)
    table = np.zeros((BUCKETS // BLOCK, BLOCK * DIM))
    for row in part.collect():  # BUCKETS x DIM numbers for every corpus
        table[row["block"]] += np.frombuffer(row["part"])
    return table.reshape(BUCKETS, DIM)


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Directions of the context vectors, around their common mean; unseen words are 0."""
    size = np.linalg.norm(context, axis=1)
    mean = context.sum(0) / max(size.sum(), 1e-9)
    return np.where(size[:, None] > 0, context / np.maximum(size, 1e-9)[:, None] - mean, 0).astype(np.float32)


FEATURES = 2 * DIM + 2


def pool(vectors: np.ndarray, text: str) -> np.ndarray:
    w = tokens(text)
    if not len(w):
        return np.zeros(FEATURES, np.float32)
    x = vectors[w]
    mean = x.mean(0)
    return np.concatenate((mean, x.std(0), [np.linalg.norm(mean), len(np.unique(w)) / len(w)])).astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Word vectors of all of docs, then the network on its labelled rows; the last of four parts of these sets the temperature."""
    vectors = word_vectors(context_vectors(docs))
    return fit(docs, teachers(labels, "quality", sample), partial(pool, vectors), Network(), held_part=3)
