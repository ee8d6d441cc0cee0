"""Alignment of two tokenizers against a plain count, and its parts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablewarden.llm import alignment

A, B, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN


def _libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(texts):
    """Of each text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), by whole encodings and loops."""
    a, b = _libraries()
    byte = alignment._unmapped()
    kept, documents, most = [], Counter(), defaultdict(int)
    for text in texts:
        whole = (" " + (text or "")).encode()
        ia, ib = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        ba = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        pieces = map(b.id_to_piece, ib)
        bb = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]
        if not text or b"".join(ba) != whole or b"".join(bb) != whole:
            kept.append(None)
            continue
        links, groups, na, nb, pa, pb = [], [([], [])], 0, 0, 0, 0
        while na < len(ia) or nb < len(ib):
            ea, eb = pa + len(ba[na]), pb + len(bb[nb])
            links.append((ia[na], ib[nb]))
            if ea <= eb:
                groups[-1][0].append(ia[na])
            if eb <= ea:
                groups[-1][1].append(ib[nb])
            if ea == eb:
                groups.append(([], []))
            if ea <= eb:
                pa, na = ea, na + 1
            if eb <= ea:
                pb, nb = eb, nb + 1
        groups.pop()
        documents.update(set(links))
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        kept.append((len(ia), len(ib), len(groups), links, hashlib.sha256(said.encode()).hexdigest()))
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    out = []
    for k in kept:
        if k is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            counts = [documents[p] for p in k[3]]
            out.append((*k[:3], len(k[3]), sum(n == most[p[0]] for p, n in zip(k[3], counts, strict=True)), sum(counts), k[4]))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(df, **more):
    rows = df.select("doc_id", "text").collect()
    got = Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in alignment.align_texts(df, A, B, PATTERN, **more).collect())
    assert got == Counter((r["doc_id"], *x) for r, x in zip(rows, brute([r["text"] for r in rows]), strict=True))


def test_given_documents(docs):
    same(docs)


def test_odd_texts(odd, none):
    same(odd)
    assert alignment.align_texts(none, A, B, PATTERN).count() == 0


def test_strange_strings(spark):
    rng = random.Random(1)
    bits = ["a", " ", "  ", "the", "é", "東京", "😀", "\n", "\t", "▁", "\x00", "<s>", "<unk>", "<|endoftext|>", "<0x41>", " ", "ﬁ", "́", "1", "'s", ".", "\r\n", "​", "ſ", "�", "ꙮ", "𐐀"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 14))) for _ in range(1500)]
    same(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))


def test_small_blocks_slices_and_salts(docs, monkeypatch):
    """Many runs, levels, chunks and salts: the same results. The package goes to workers as files, so this runs the parts here."""
    for name, value in {"BLOCK": 7, "FAN": 3, "SPOOL": 100, "CHUNK": 20}.items():
        monkeypatch.setattr(alignment, name, value)
    rng = np.random.default_rng(2)
    levels, whole = alignment.Levels(), Counter()
    for _ in range(40):
        pairs = np.unique(rng.integers(0, 500, rng.integers(1, 120)))
        counts = rng.integers(1, 2**34, len(pairs))
        whole.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        levels.add(alignment.write_run(pairs, counts))
    parts = list(levels.totals())
    got = dict(zip(np.concatenate([p for p, _ in parts]).tolist(), np.concatenate([c for _, c in parts]).tolist(), strict=True))
    assert got == dict(whole) and list(got) == sorted(got)
    assert len(levels.levels) >= 3


def test_salts_split_a_hot_radix(docs, monkeypatch):
    monkeypatch.setattr(alignment, "SALT", 2000)
    same(docs.repartition(7), radixes=3)


def test_decimals():
    ids = np.array([0, 9, 10, 99, 100, 12345, 50256, 7, 9999])
    text, stops = alignment._decimals(ids, np.full(len(ids), ord(";"), np.uint8), *alignment._digits(50257))
    assert text.tobytes().decode() == ";".join(map(str, ids)) + ";" and stops[-1] == len(text)


def test_long_runs_are_quick(spark):
    texts = ["a" * 1_000_000, " " * 300_000, "é" * 300_000, "东" * 200_000, "ab" * 400_000 + " x"]
    rows = alignment.align_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), A, B, PATTERN).collect()
    assert len(rows) == 5 and all(r["n_links"] >= max(r["n_a"], r["n_b"]) > 0 for r in rows)


@pytest.mark.parametrize("bad", ["▁", "a▁b"])
def test_the_space_mark_is_no_space(spark, bad):
    row = alignment.align_texts(spark.createDataFrame([(1, bad), (2, "a b")], "doc_id long, text string"), A, B, PATTERN).orderBy("doc_id").collect()
    assert row[0]["n_a"] == 0 and row[0]["groups_sha256"] == "" and row[1]["n_links"] > 0
