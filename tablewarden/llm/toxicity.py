"""Toxicity: boosted trees over dense features of the text, with isotonic calibration.

Features: densities of a fixed lexicon and of one mined from teachers (words and word beginnings that toxic
texts have far more often), how near such words stand to the second person, capitals, punctuation, and words
spelt with figures or signs in place of letters. The teachers that the lexicon is mined from do not fit the
trees, and those that calibrate do neither.

Nulls: a null text is the empty text (all features 0). Without teachers, or with one kind only, every score is
the share of label 1 among them (0.5 without any). Empty tables give empty tables. Rows of equal doc_id are
scored each for itself, equal texts alike; labels, lang and source never enter a score. Very long texts are described
whole. Ties in the mined lexicon go to the smaller hash. doc_id is an integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, map_rows, prefix_hash, runs, span_hash
from .labelled import SAMPLE, Scorer, fit, teachers
from .models import Trees

# Insults, and words of the second person, in the corpus' languages.
INSULTS = ["idiot", "moron", "stupid", "loser", "pathetic", "scum", "trash", "worthless", "clown", "disgusting", "dumb", "imbecile", "fool", "garbage", "vermin", "filth", "dummkopf", "trottel", "arschloch", "blöd", "widerlich", "abschaum", "imbécile", "crétin", "débile", "ordure", "connard", "estúpido", "imbécil", "idiota", "basura", "asqueroso"]
SECOND = ["you", "your", "yours", "youre", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros"]
# Signs that stand in for letters.
STAND_IN = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

#: Bytes of the word beginnings that are mined; toxic teachers that must have a term, log-likelihood ratio (in nats) by which
#: toxic teachers must have it more often than by chance, and terms kept at most.
BEGINNINGS, SUPPORT, SURE, TERMS = (4, 5, 6), 4, 12.0, 4000
#: Parts of the teachers (by hash) that the lexicon is mined from; of the others, the last calibrates.
MINED, FITTED = (0, 1), (2, 3)

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 36, 64, *range(128, 256)]] = True
_PLAIN = LOWER.copy()
for _a, _b in STAND_IN.items():
    _PLAIN[ord(_a)] = ord(_b)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in STAND_IN]] = True
_SIGN = ~_WORD
_SIGN[[9, 10, 11, 12, 13, 32]] = False


def hashed(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0])
    return np.unique(np.array(out, np.uint64))


def within(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of each x in the sorted table, or -1."""
    if not len(table):
        return np.full(len(x), -1)
    i = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[i] == x, i, -1)


def terms(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words and of their beginnings; a word that is shorter has the hash 0 in place of one."""
    p = prefix_hash(low)
    out = [span_hash(p, starts, ends)]
    for n in BEGINNINGS:
        long = ends - starts > n
        # a beginning and a whole word of the same bytes are two terms
        out.append(np.where(long, span_hash(p, starts, np.minimum(starts + n, ends)) ^ np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0)))
    return out


def mine(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """From text, label: sorted term hashes and their log-odds. Term counts are summed by Spark; TERMS rows come to the driver at most."""
    schema = pa.schema([("term", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def make():
        def step(c):
            found = ([], [])
            for text, label in zip(c["text"], c["label"], strict=True):
                low = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
                all_terms = np.unique(np.concatenate(terms(low, *runs(_WORD[low]))))
                found[0 if label else 1].append(all_terms[all_terms > 0])
            sets = [np.unique(np.concatenate(f), return_counts=True) if f else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for f in found]
            # clean counts matter for terms of toxic texts only, but those may stand in another task
            keys = np.union1d(sets[0][0], sets[1][0])
            counts = [np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)]
            for k, (t, n) in zip(counts, sets, strict=True):
                k[np.searchsorted(keys, t)] = n
            return {"term": keys.view(np.int64).tolist(), "toxic": counts[0].tolist(), "clean": counts[1].tolist()}

        return step

    sizes = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    both = map_rows(df.select("text", "label"), make, schema, rows=4096).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).filter(F.col("t") >= SUPPORT)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    share = toxic / max(1, toxic + clean)
    n = F.col("t") + F.col("c")
    sure = F.col("t") * F.log(F.col("t") / n / max(share, 1e-9)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / n / max(1 - share, 1e-9))).otherwise(0.0)
    rows = both.select("term", odds.alias("odds"), sure.alias("sure")).filter((F.col("sure") >= SURE) & (F.col("odds") > 0)).orderBy(F.desc("sure"), "term").limit(TERMS).collect()
    table = np.array([r["term"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(table)
    return table[order], np.array([r["odds"] for r in rows])[order] if rows else np.zeros(0)


class Describer:
    def __init__(self, table: np.ndarray, odds: np.ndarray):
        self.table, self.odds, self.insults, self.second = table, odds, hashed(INSULTS), hashed(SECOND)

    def __call__(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), np.uint8)
        low = LOWER[data]
        starts, ends = runs(_WORD[data])
        n = len(starts)
        if not n:
            return np.zeros(18, np.float32)
        words, *begins = terms(low, starts, ends)
        fixed = within(words, self.insults) >= 0
        hit = within(words, self.table)
        weights = np.where(hit >= 0, self.odds[hit] if len(self.odds) else 0.0, 0.0)
        begin = np.zeros(n)
        for b in begins:
            i = within(b, self.table)
            begin = np.maximum(begin, np.where(i >= 0, self.odds[i] if len(self.odds) else 0.0, 0.0))
        odd = np.add.reduceat(np.concatenate((_ODD[data], [False])).astype(np.int64), starts)
        letters = np.add.reduceat(np.concatenate((_LETTER[data], [False])).astype(np.int64), starts)
        spelt = (odd > 0) & (letters > 0)
        hidden = 0
        if spelt.any():
            plain = _PLAIN[data]
            back = span_hash(prefix_hash(plain), starts[spelt], ends[spelt])
            hidden = int(((within(back, self.insults) >= 0) | (within(back, self.table) >= 0)).sum())
        bad, second = np.flatnonzero(fixed | (weights > 0) | (begin > 0)), np.flatnonzero(within(words, self.second) >= 0)
        gap = 100.0
        if len(bad) and len(second):
            i = np.searchsorted(second, bad)
            gap = float(min(np.abs(second[np.minimum(i, len(second) - 1)] - bad).min(), np.abs(second[np.maximum(i - 1, 0)] - bad).min(), 100))
        m = len(data)
        return np.array(
            [fixed.sum(), 100 * fixed.mean(), (weights > 0).sum(), 100 * weights.mean(), weights.max(), (begin > 0).sum(), 100 * begin.mean(), begin.max(), 100 * len(bad) / n, gap, 100 * len(second) / n, _UPPER[data].sum() / max(1, _LETTER[data].sum()), _SIGN[data].mean(), 100 * (data == 33).mean(), 100 * spelt.mean(), hidden, np.log1p(n), m / n],
            np.float32,
        )


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Mine the lexicon from two of the teachers' parts, grow the trees on the third, calibrate on the last."""
    chosen = teachers(labels, "toxic", sample)
    table, odds = mine(docs.select("doc_id", "text").join(F.broadcast(chosen.filter(F.col("part").isin(*MINED))), "doc_id"))
    return fit(docs, chosen.filter(F.col("part").isin(*FITTED)), Describer(table, odds), Trees(), held_part=FITTED[-1])
