"""Operators that work row by row: fingerprints, BPE, token counts, licences, media."""

import hashlib
import random
import re
import struct
import time
import zlib

import duckdb
import pyarrow as pa
import pytest
import tiktoken
from oracle import compare, connect
from pyspark.sql import functions as F

from tablewarden.llm import bpe, common, fingerprints, licenses, media, sqls, token_counts
from tablewarden.llm.queries import queries

PATH, PATTERN = bpe.default_vocabulary()


def _tiktoken():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load(PATH).ranks, special_tokens={})


# --- fingerprints --------------------------------------------------------------------------------------------


def test_fingerprint_sql(spark, sf):
    assert compare(queries()["op1_fingerprints"](spark, sf), connect(sf), sqls.OP1) == ""


@pytest.mark.parametrize("ordered", [1, 2, 4096])
def test_fingerprint_odd(spark, odd, none, monkeypatch, ordered):
    monkeypatch.setattr(fingerprints, "ORDERED", ordered)
    con = duckdb.connect()
    pdf = odd.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"})
    con.register("documents", pdf)
    assert compare(fingerprints.compare_edits(odd), con, sqls.OP1) == ""
    assert fingerprints.compare_edits(none).count() == 0


def test_single_document_is_its_own_next(spark):
    one = fingerprints.compare_edits(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()


def test_trees_keep_every_code_point(spark):
    texts = ["a\n\nb", "a\n\n\u0001b", "a\n\u0001\nb", "a\n\n\nb", "\n\na", "a\n\n", "a.b", "a. b", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.select(fingerprints.root(fingerprints.leaves(F.col("text")))).distinct().count() == len(texts)
    whole = F.array_join(F.flatten(F.transform(fingerprints.sections(F.col("text")), lambda s: F.regexp_extract_all(s, F.lit(fingerprints.PARAGRAPHS), F.lit(0)))), "")
    assert df.filter(~F.col("text").contains("\u0001")).filter(whole != F.col("text")).count() == 0


def test_edits_are_located(spark):
    text = "\n\n".join(f"Section {i}. Some words here." for i in range(6))
    df = spark.createDataFrame([(text, text.replace("Section 3", "Part 3"))], "a string, b string")
    a, b = (fingerprints.branch_hashes(fingerprints.leaves(F.col(c))) for c in "ab")
    assert df.select(fingerprints.changed_branches(a, b)).first()[0] == [3]


# --- BPE -----------------------------------------------------------------------------------------------------


def test_bpe_like_tiktoken_on_odd_texts(odd, none):
    enc = _tiktoken()
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_texts(odd, "doc_id", "text", PATH, PATTERN).collect()}
    for r in odd.collect():
        assert got[r["doc_id"]] == enc.encode_ordinary(r["text"] or "")
    back = bpe.decode_ids(bpe.encode_texts(odd, "doc_id", "text", PATH, PATTERN), "doc_id", "ids", PATH)
    assert {r["doc_id"]: bytes(r["text"]).decode() for r in back.collect()} == {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    assert bpe.digest_texts(none, PATH, PATTERN).count() == 0


def test_digests_like_tiktoken(odd, docs, spark, sf):
    enc, sha = _tiktoken(), hashlib.sha256
    want = lambda t: (len(enc.encode_ordinary(t)), sha(" ".join(map(str, enc.encode_ordinary(t))).encode()).hexdigest(), sha(t.encode()).hexdigest())
    for df, got in ((odd, bpe.digest_texts(odd, PATH, PATTERN)), (docs, queries()["op2_bpe"](spark, sf))):
        have = sorted(map(repr, (tuple(r)[:4] for r in got.collect())))
        assert have == sorted(repr((r["doc_id"], *want(r["text"] or ""))) for r in df.collect())


def test_bpe_memories_are_bounded(monkeypatch):
    """The same ids when the memories of pre-tokens, pairs and steps are emptied all the time."""
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    enc, small, text = _tiktoken(), bpe.Encoder.__new__(bpe.Encoder), "some words, other words; größere Wörter 東京 " * 3
    small.bpe, small.find = bpe.PrefixBPE(bpe.load(PATH).ranks), token_counts.compiled(PATTERN).findall
    small.known = bpe.Generations(lambda p: b"".join(i.to_bytes(4, "little") for i in small.bpe.encode(p.encode())), 3)
    assert small.encode(text) == enc.encode_ordinary(text) and len(small.known) <= 3 and small.bpe.suffixes.added <= 5


def test_bpe_random_pieces():
    enc, own, rng = _tiktoken(), bpe.load(PATH), random.Random(5)
    for alphabet in ("ab", "theron", "aàé 東", " \n\t", "0123", "!?.-"):
        for _ in range(300):
            t = "".join(rng.choices(alphabet, k=rng.randint(1, 24)))
            for p in re.findall(r"\S+|\s+", t):
                assert own.encode(p.encode()) == enc._encode_single_piece(p)


def test_bpe_appends_and_edits_go_on_from_the_table():
    own = bpe.load(PATH)
    last, start = [], []
    for end in range(1, 12):
        own.extend(b"unbelievably"[:end], last, start)
        assert own.read(last, start) == own.encode(b"unbelievably"[:end])
    new = own.edit(b"unbelieving", last, start, at=9)
    assert own.read(*new) == own.encode(b"unbelieving")


# --- token counts --------------------------------------------------------------------------------------------


def _same_as_built(t, text):
    built = token_counts.CountedText(text, t.count, t.pattern)
    assert (t.text, t.lengths, t.counts) == (text, built.lengths, built.counts)
    assert (t.n_chars, t.n_pretokens, t.n_tokens) == (len(text), len(built.lengths), sum(built.counts))


@pytest.mark.parametrize("fan", [2, 3, 64])
@pytest.mark.parametrize("pattern", [PATTERN, "[ab]+|1(?=!)"])
def test_counts_after_edits(fan, pattern, monkeypatch):
    monkeypatch.setattr(token_counts, "FAN", fan)
    monkeypatch.setattr(token_counts, "WINDOW", 2)
    enc, rng = bpe.encoder(PATH, PATTERN), random.Random(3)
    for _ in range(150):
        t = token_counts.CountedText("".join(rng.choices("ab 'st\n1!é", k=rng.randint(0, 90))), enc.counts, token_counts.compiled(pattern))
        for _ in range(5):
            before, lo = t.text, rng.randint(0, t.n_chars + 2)
            hi, new = lo + rng.randint(0, 12), "".join(rng.choices("ab 's\n2", k=rng.randint(0, 9)))
            t.edit(lo, hi, new)
            _same_as_built(t, before[:lo] + new + before[hi:])
            if pattern == PATTERN:
                assert t.n_tokens == len(enc.encode(t.text)), t.text


def test_an_edit_touches_few_pieces():
    enc = bpe.encoder(PATH, PATTERN)
    t = token_counts.CountedText("some words in a row " * 5000, enc.counts, token_counts.compiled(PATTERN))
    assert t.edit(50_000, 50_004, "other") < 10
    assert t.edit(0, 0, "x") < 10 and t.edit(t.n_chars, t.n_chars, "x") < 10


def test_the_tree_stays_low_under_many_edits():
    enc, rng = bpe.encoder(PATH, PATTERN), random.Random(4)
    t, plain = token_counts.CountedText("", enc.counts, token_counts.compiled(PATTERN)), ""
    for _ in range(3000):
        at = rng.randint(0, len(plain))
        t.edit(at, at, " new words")
        plain = plain[:at] + " new words" + plain[at:]
    _same_as_built(t, plain)
    depth, node = 0, t.root
    while isinstance(node, token_counts.Node):
        depth, node = depth + 1, node.below[0]
    assert depth <= 4 and max(len(b.lengths) for b in t.root.blocks()) <= 2 * token_counts.FAN


def _edited(rows):
    return {r["doc_id"]: (r["text"] or "")[: r["lo"] or 0] + (r["new"] or "") + (r["text"] or "")[max(r["lo"] or 0, r["hi"] or 0) :] for r in rows}


def test_counts_of_odd_rows(odd, docs, none):
    """Every column against the library's counts of the text before and after."""
    enc, pat = _tiktoken(), token_counts.compiled(PATTERN)
    sizes = lambda t: (len(t), len(pat.findall(t)), len(enc.encode_ordinary(t)))
    for df in (odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), docs):
        edits = df.withColumns({"lo": F.lit(1), "hi": F.when(F.col("doc_id") != 1, F.lit(10**6)), "new": F.when(F.col("doc_id") != 4, F.lit("X"))})
        rows = edits.collect()
        own, after = {r["doc_id"]: r["text"] or "" for r in rows}, _edited(rows)
        trees = token_counts.build_trees(df, PATH, PATTERN).join(edits.select("doc_id", "lo", "hi", "new"), "doc_id")
        got = token_counts.edit_trees(trees, PATH, PATTERN).collect()
        assert len(got) == len(rows)
        for r in got:
            assert tuple(r)[1:4] == sizes(own[r["doc_id"]]) and tuple(r)[4:7] == sizes(after[r["doc_id"]])
            assert r["text"] == after[r["doc_id"]] and sum(r["lengths"]) == len(r["text"]) and sum(r["counts"]) == r["edited_n_tokens"]
    assert token_counts.build_trees(odd, PATH, PATTERN).count() == odd.count()
    empty = none.select("doc_id", "text").withColumns({"lengths": F.array().cast("array<int>"), "counts": F.array().cast("array<int>"), "lo": F.lit(0), "hi": F.lit(0), "new": F.lit("")})
    assert token_counts.edit_trees(empty, PATH, PATTERN).count() == token_counts.build_trees(none, PATH, PATTERN).count() == 0


def test_token_count_query(spark, sf, docs):
    enc, pat = _tiktoken(), token_counts.compiled(PATTERN)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = queries()["op5_token_counts"](spark, sf).collect()
    assert len(rows) == docs.count()
    for r in rows:
        t = texts[r["doc_id"]]
        e = t[: len(t) // 3] + t[-20:] + t[len(t) // 3 + 40 :]
        assert tuple(r)[1:7] == tuple(n for x in (t, e) for n in (len(x), len(pat.findall(x)), len(enc.encode_ordinary(x))))
        assert r["n_reencoded"] <= 70


def test_lists_leave_arrow_at_once():
    """Slices, nulls and empty lists as to_pylist has them, and long lists for less than half of its time."""
    rng, kind = random.Random(4), pa.list_(pa.int32())
    some = [None if k % 7 == 3 else [rng.randint(-(2**31), 2**31 - 1) for _ in range(rng.randint(0, 5))] for k in range(60)]
    held = pa.ListArray.from_arrays(pa.array([0, 2, 3, 5], pa.int32()), pa.array(range(5), pa.int32()), mask=pa.array([False, True, False]))
    for column in (pa.array(some, kind), pa.array([x or [] for x in some], kind), pa.array([[1, None], [], None], kind), pa.array([None] * 3, kind), pa.array([], kind), pa.array(["a", None]), held):
        for at in range(0, len(column) + 1, 5):
            for part in (column.slice(at), column.slice(at, 2)):
                assert common.plain(part) == part.to_pylist()
    long = pa.array([list(range(2000))] * 200, kind)
    spent = []
    for f in (common.plain, pa.Array.to_pylist):
        began = time.process_time()
        f(long)
        spent.append(time.process_time() - began)
    assert spent[0] < spent[1] / 2


# --- licences ------------------------------------------------------------------------------------------------


def _brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_phrases(docs, odd, none):
    for df in (docs, odd):
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        for r in licenses.scan_licenses(df).collect():
            assert tuple(r)[1:6] == _brute(texts[r["doc_id"]])
    assert licenses.scan_licenses(none).count() == 0


def test_templates(spark):
    text = f"junk before {licenses.TEMPLATES['mit']} and after; this file is all rights reserved, cc by cc by"
    r = licenses.scan_licenses(spark.createDataFrame([(1, text.replace("copies", "copy")), (2, "nothing at all")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert r[0]["labels"] == "cc-by,mit,reserved" and r[0]["n_base"] == 3
    assert any(s["template"] == "mit" and s["first_word"] == 2 for s in r[0]["spans"])
    assert (r[1]["labels"], r[1]["score"], r[1]["spans"]) == ("", 0.0, [])


def _with_foreign(text, words):
    return " ".join(w + f" {words[i % len(words)]}" * (i % 7 == 6) for i, w in enumerate(re.findall(r"[A-Za-z0-9]+", text)))


@pytest.mark.parametrize("foreign", [["xyzzy"], ["the", "of", "software"]])
@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_template_with_foreign_words_and_no_other(name, foreign):
    s = licenses.scanner_of(tuple(licenses.BASE.items()), tuple(licenses.TEMPLATES.items()))
    for text in (licenses.TEMPLATES[name], _with_foreign(licenses.TEMPLATES[name], foreign)):
        cover = s.scan(f"some words first {text} and some after")[3]
        assert {k for k, x in cover.items() if x >= licenses.COVER} == {name}, cover


def test_templates_are_a_parameter(spark, odd):
    df = spark.createDataFrame([(1, "first one two three four five then one two three four five again one two three four five"), (2, None), (3, "")], "doc_id long, text string")
    r = licenses.scan_licenses(df, base={"then": "t"}, templates={"own": "one two three four five"}).orderBy("doc_id").collect()
    assert (r[0]["labels"], r[0]["n_base"], [x["first_word"] for x in r[0]["spans"]]) == ("own,t", 1, [1, 7, 13])
    assert (r[1]["labels"], r[2]["score"]) == ("", 0.0)


def test_all_labels_of_a_text_that_joins_two_notices():
    s = licenses.scanner_of(tuple(licenses.BASE.items()), tuple(licenses.TEMPLATES.items()))
    cover = s.scan(licenses.TEMPLATES["lgpl-notice"] + " . and " + licenses.TEMPLATES["gpl-notice"] * 2 + licenses.TEMPLATES["isc"])[3]
    assert {k for k, x in cover.items() if x >= licenses.COVER} == {"lgpl-notice", "gpl-notice", "isc"}


def test_places_of_states():
    """Every state's places are those of its words in the sequences."""
    rng = random.Random(4)
    seqs = [[rng.randint(0, 2) for _ in range(rng.randint(1, 14))] for _ in range(6)]
    sa = licenses.SuffixAutomaton(seqs)
    for q in seqs:
        for a in range(len(q)):
            for b in range(a + 1, len(q) + 1):
                want = sorted((k, i + b - a - 1) for k, p in enumerate(seqs) for i in range(len(p) - (b - a) + 1) if p[i : i + b - a] == q[a:b])
                assert sorted(sa.ends[sa.walk(q[a:b])]) == want


def test_automaton_statistics():
    """Longest suffix that stands in a sequence, against all substrings."""
    rng = random.Random(1)
    seqs = [[rng.randint(0, 3) for _ in range(rng.randint(1, 12))] for _ in range(5)]
    s = licenses.Scanner({}, {})
    s.sa = licenses.SuffixAutomaton(seqs)
    s.phrases = [()] * len(s.sa.next)
    known = {tuple(q[a:b]) for q in seqs for a in range(len(q)) for b in range(a + 1, len(q) + 1)}
    text = [rng.randint(0, 4) for _ in range(500)]
    got = {i: n for i, _, n in s.statistics(text)}
    for i in range(len(text)):
        want = max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in known), default=0)
        assert got.get(i, 0) == want


# --- media ---------------------------------------------------------------------------------------------------


def _png():
    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


GIF = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff\x2c\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02\x44\x01\x00\x3b"


@pytest.mark.parametrize("data,kind", [(_png(), "image/png"), (GIF, "image/gif"), (media.to_wav(b"x" * 33), "audio/wav"), (b"BM" + struct.pack("<IIII", 58, 0, 54, 40) + bytes(40), "image/bmp"), (b"%PDF-1.4 startxref 0 %%EOF", "application/pdf"), (b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x02zz\xff\x00z\xff\xd9", "image/jpeg"), (b"PK\x03\x04abcdPK\x01\x02" + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 1, 1, 4, 8, 0), "application/zip")])
def test_formats(data, kind):
    assert media.sniff(data) == [(kind, 0, len(data))]
    assert media.sniff(b"head" + data + b"tail") == [(kind, 4, len(data))]
    assert media.sniff(data[:-3]) == [] or kind == "audio/flac"
    assert media.sniff(media.to_wav(data))[1] == (kind, 44, len(data))


@pytest.mark.parametrize("piece", [*media.MAGIC, b"%PDF-%%EOF", b"PK\x03\x04PK\x05\x06" + bytes(18), b"\xff\xd8\xff\xda\x00\x02", b"GIF89a" + bytes(7) + b"\x21\xf9\x01", b"RIFF\x04\0\0\0WAVE"])
def test_a_megabyte_of_beginnings_is_quick(piece):
    began = time.process_time()
    media.sniff(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 4  # linear: some tenths of a second on a free machine


def _heads(head, shared, size=1_000_000):
    """Many beginnings, each of which leads into the part that all share."""
    n = (size - len(shared)) // len(head(0))
    each = len(head(0))
    return b"".join(head((n - i - 1) * each) for i in range(n)) + shared


SHARED = {
    # a JPEG whose scan never ends, from each of the heads
    "jpeg": (lambda rest: b"\xff\xd8\xff\xe0" + struct.pack(">H", min(65535, rest + 2)) + b"\xff\xda\0\2", b"\xff\0" * 400_000),
    # a chain of empty blocks that no frame follows
    "flac": (lambda rest: b"fLaC\0\0\0\x22" + bytes(34) + b"\x01" + rest.to_bytes(3, "big"), b"\x01\0\0\0" * 100_000),
    # long chunks with wrong sums that lead to one end
    "png": (lambda rest: b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + bytes(13) + struct.pack(">I", zlib.crc32(b"IHDR" + bytes(13))) + struct.pack(">I", rest + 500_000) + b"long", bytes(500_000) + b"sums" + struct.pack(">I", 0) + b"IEND" + struct.pack(">I", zlib.crc32(b"IEND"))),
    # a chain of chunks whose end none of the heads says
    "wav": (lambda rest: b"RIFF" + struct.pack("<I", rest + 8 * 1000) + b"WAVEfmt " + struct.pack("<I", rest), b"data\0\0\0\0" * 60_000),
}


@pytest.mark.parametrize("name", sorted(SHARED))
def test_beginnings_that_share_a_part_are_quick(name):
    data = _heads(*SHARED[name])
    began = time.process_time()
    media.sniff(data)
    assert time.process_time() - began < 6  # about a second on a free machine; minutes if each beginning walked for itself


def test_sums_of_parts():
    data = random.Random(2).randbytes(300_000)
    b = media.Buffer(data)
    for start, end in ((0, 0), (0, 300_000), (5, 200_000), (16384, 299_999), (1, 70_000), (100, 65_637)):
        assert b.crc(start, end) == zlib.crc32(data[start:end])


def _plain_wav(b, at):
    if b[at : at + 4] != b"RIFF" or b[at + 8 : at + 12] != b"WAVE" or len(b) < at + 12:
        return 0
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    pos, seen = at + 12, set()
    while pos + 8 <= end <= len(b):
        size = struct.unpack_from("<I", b, pos + 4)[0]
        seen.add(b[pos : pos + 4])
        pos += 8 + size + (size & 1)
    return end - at if pos == end and {b"fmt ", b"data"} <= seen else 0


def test_chunks_walked_together_are_the_chunks_walked_alone():
    rng = random.Random(7)
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(3, 40)):
            size = rng.choice([0, 0, 2, 3, 8, 20, 100])
            parts.append(rng.choice([b"fmt ", b"data", b"LIST", b"RIFF"]) + struct.pack("<I", size) + rng.choice([b"WAVE" + bytes(96), bytes(100)])[:size])
        data = b"".join(parts)
        b = media.Buffer(data)
        for at in range(len(data)):
            if data[at : at + 4] == b"RIFF":
                assert media._wav(b, at) == _plain_wav(data, at)


def test_files_of_one_archive_and_two_archives():
    def archive(files):
        body = b"".join(b"PK\x03\x04" + f for f in files)
        return body + b"PK\x01\x02" + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 1, 1, 4, len(body), 0)

    one, two = archive([b"abc", b"defg"]), archive([b"x"])
    assert media.sniff(one + two) == [("application/zip", 0, len(one)), ("application/zip", len(one), len(two))]


def test_feature_text():
    data = bytes([0, 255, 0, 255, 128, 128])
    assert media.features("audio/wav", data, 0) == f"audio/wav;rate=8000;samples=6;mean={766 * 1000 // 6};power={(2 * 128**2 + 2 * 127**2) // 6};crossings=3;carved=0"


def test_sniff_column(spark):
    df = spark.createDataFrame([(1, _png(), "image/gif"), (2, b"BM plain text", None), (3, None, "image/png"), (4, GIF, "image/gif")], "id long, data binary, declared string")
    got = {r["id"]: (r["type"], r["was_right"]) for r in media.sniff_column(df, "id", "data", "declared").collect()}
    assert got == {1: ("image/png", False), 2: (media.UNKNOWN, False), 3: (media.UNKNOWN, False), 4: ("image/gif", True)}


def test_media_round_trip(odd, docs, none):
    for df in (odd, docs):
        texts = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
        for r in media.read_media(media.store_texts(df)).collect():
            raw = texts[r["doc_id"]]
            padded = raw.ljust(max(192, -(-len(raw) // 192) * 192))
            stored = media.to_wav(padded)
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
            assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(padded[-16:]), len(stored), hashlib.sha256(stored).hexdigest())
            assert r["type"] == "audio/wav" and not r["was_right"]
    assert media.read_media(media.store_texts(none)).count() == 0
