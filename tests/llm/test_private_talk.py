"""Personal data and conversations: SQL, brute force, odd rows."""

import hashlib
import random
import re
from itertools import product

import duckdb
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tablewarden.llm import conversations, pii, sqls
from tablewarden.llm.queries import queries


@pytest.mark.parametrize("name", ["op12_conversations", "op13_pii"])
def test_sql(name, spark, sf):
    assert compare(queries()[name](spark, sf), connect(sf), sqls.oracle_sql()[name]) == ""


# --- personal data -------------------------------------------------------------------------------------------

PLANTED = (
    [f"Please call me at +1 (20{i}) 555-01{i}0 today." for i in range(6)]
    + ["You may call me at 555-0147-88 tonight.", "please CALL ME AT 555 0199 22.", "call me at 5 pm", "call me at 1.2.3.4 or call me at 555-0147-88"]
    + [f"reach us: a{i}@mail{i}.example.com now" for i in range(6)]
    + ["reach us: bob@localhost now", "reach us: carol (at) mail.example now", "see 555-0147-88 elsewhere"]
    + [f"my card number 4539 1488 0343 646{i} expires" for i in range(10)]
    + ["x a@b.c_d@e.f y", "1.2.3.4.5.6.7.8 and 300.1.1.1 and 001.02.3.255.", "+1 2 +12-34-56-78-90. (+49) 30-1234567-"]
)


@pytest.fixture(scope="module")
def planted(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(PLANTED)], "doc_id long, text string").repartition(3)


def same(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    return compare(pii.digest_private(df), con, sqls.OP13)


def test_private_odd(odd, none, planted):
    assert same(odd) == ""
    assert pii.digest_private(none).count() == 0
    assert same(planted) == ""


def test_patterns_find_unseen_identifiers(planted):
    found = {r["doc_id"]: r for r in pii.digest_private(planted).collect()}
    at = {t: i for i, t in enumerate(PLANTED)}
    assert found[at["You may call me at 555-0147-88 tonight."]]["spans"] == "phone:19:30"
    assert found[at["please CALL ME AT 555 0199 22."]]["spans"] == "phone:18:29"
    assert found[at["call me at 5 pm"]]["spans"] == "" and found[at["see 555-0147-88 elsewhere"]]["spans"] == ""
    assert found[at["call me at 1.2.3.4 or call me at 555-0147-88"]]["spans"] == "ip:11:18,phone:33:44"
    assert found[at["reach us: bob@localhost now"]]["spans"] == "email:10:23" and found[at["reach us: carol (at) mail.example now"]]["n_found"] == 1


def test_bootstrapping_takes_rounds(spark):
    """Seeds make one context sure, its finds make another one sure."""
    texts = [f"dial now +1 (20{i}) 555-01{i}0." for i in range(9)] + [f"dial now 555-0147-{i}{i} ok" for i in range(4)] + [f"ring bell 555-0147-{i}{i} ok" for i in range(4)]
    texts += [f"ring bell +1 (20{i}) 555-01{i}0." for i in range(4)] + ["ring bell 777-0147-99 ok"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    texts_df = pii.read_texts(df)
    one, three = pii.learn_patterns(texts_df, rounds=1), pii.learn_patterns(texts_df, rounds=3)
    sure = lambda p: {r["pattern"] for r in p.collect()}
    assert "2 ring bell" not in sure(one) and "2 ring bell" in sure(three)
    assert pii.discover(texts_df, three).count() == 9 and same(df) == ""


def _base(text):
    """The contract, with Python's own matcher."""
    out = []
    for kind in pii.KINDS:
        for m in re.finditer(pii.PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_equal_a_plain_matcher(spark):
    rng = random.Random(5)
    bits = ["a", "b.c", "@", "é", "-", ".", " ", "1", "23", "4539148803436467", "0000000000000", "+", "(", ")", "_", "%", "a@b.c", "1.2.3.4", "256", "😀", "\n", "+1 (017) 555-7713"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("text", pii._said(pii.base_spans(F.col("text"))).alias("said")).collect()
    assert [(r["text"], r["said"]) for r in rows if r["said"] != _base(r["text"])] == []


def test_base_spans_of_long_texts_are_quick(spark):
    texts = ["a" * 1_000_000, "1" * 1_000_000, "+1" + "-1" * 500_000, "a@b" + ".c" * 300_000, "1.2.3.4 " * 100_000, "a.b-" * 250_000 + "@", "1 " * 400_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in pii.digest_private(df).select("doc_id", "n_email", "n_ip", "n_card", "n_phone").collect()}
    assert got[4]["n_ip"] == 100_000 and got[3]["n_email"] == 1 and got[0]["n_email"] == 0


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 70_000):
        values = [(i * 7919) % 13 for i in range(n)]
        got = spark.createDataFrame([(values,)], "a array<long>").select(pii.running_sums(F.col("a"))).first()[0]
        want, total = [], 0
        for v in values:
            total += v
            want.append(total)
        assert got == want


def test_no_python_in_private(planted):
    plan = pii.digest_private(planted)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- conversations -------------------------------------------------------------------------------------------


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _brute(rows):
    """(cost, audit, repaired) of the best of all edits."""
    faults = _faults(rows)
    best = None
    for edits in product(*[[i + e for i in ("", "Iu", "Ia") for e in (["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"])] for f in faults]):
        for last in ("", "Iu", "Ia"):
            cost, audit, out = 0, "", []
            for (_, role, text), f, e in zip(rows, faults, edits, strict=True):
                if e[0] == "I":
                    cost, audit, out = cost + 5, audit + "I", [*out, ("user" if e[1] == "u" else "assistant", "")]
                    e = e[2:]
                audit += e[0]
                cost += {"K": 0, "R": 1, "D": 2}[e[0]] + (5 if f == "truncated" and e[0] != "D" else 0)
                if e[0] != "D":
                    out.append((role if e == "K" else "user" if e == "Ru" else "assistant", text))
            if last:
                cost, audit, out = cost + 5, audit + "I", [*out, ("user" if last == "Iu" else "assistant", "")]
            if all(r for r, _ in out) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out))
    return best


def test_repair_is_the_cheapest(spark):
    rng = random.Random(3)
    talks = [[(t, rng.choice(["user", "assistant", "system", "tool", "", "user"]), rng.choice(["a.", "b!", "c", "", " ", "d?", f"x{t}."])) for t in sorted(rng.choices(range(6), k=rng.randrange(0, 6)))] for _ in range(120)]
    talks = [sorted(t) for t in talks]
    rows = [(i, *r) for i, t in enumerate(talks) for r in t]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r["conv_id"]: r for r in conversations.audit_conversations(df).collect()}
    repaired = {}
    for r in conversations.repair_conversations(df).orderBy("conv_id", "place").collect():
        repaired.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for i, talk in enumerate(talks):
        if talk:
            cost, audit, out = _brute(talk)
            assert (got[i]["cost"], got[i]["audit"]) == (cost, audit), talk
            assert got[i]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
            assert repaired.get(i, []) == out
            faults, firsts = _faults(talk), [r[:1] for _, r, _ in talk]
            assert [got[i][k] for k in ("blank", "duplicate", "truncated")] == [faults.count(k) for k in ("blank", "duplicate", "truncated")]
            assert got[i]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))


def test_damage_and_odd_rows_equal_sql(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, *range(9)]), rng.choice([None, "user", "assistant", "system", "x"]), rng.choice([None, "", "Hi.", "no end", "A?\n", "b! ", "é."]), "own", "own") for _ in range(160)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copy string, seen string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    got = conversations.audit_conversations(conversations.damage(df), dropped="dropped")
    assert compare(got, con, sqls.OP12) == ""
    assert got.count() == len({r[0] for r in rows})
    assert conversations.audit_conversations(conversations.damage(df.limit(0)), dropped="dropped").count() == 0


def test_giant_conversations_spill(spark, monkeypatch):
    """One conversation over many batches and spools: the same audit as in memory, by a program that is checked above."""
    n = 60_000
    df = spark.range(n).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 5 == 0, "user").when(F.col("id") % 7 == 0, "system").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id") % 900, F.when(F.col("id") % 3 == 0, "").otherwise(".")).alias("text"))
    whole = conversations.audit_conversations(df).first()
    monkeypatch.setattr(conversations, "SPOOL", 1000)
    monkeypatch.setattr(conversations, "BACK", 64)
    talk = conversations.Conversation(7)
    seen = set()
    for i in range(n):
        role = "user" if i % 5 == 0 else "system" if i % 7 == 0 else "assistant"
        text = f"t{i % 900}" + ("" if i % 3 == 0 else ".")
        talk.add(i, role, text, False, (role, text) in seen, i % 3 == 0)
        seen.add((role, text))
    row, repaired = talk.finish()
    assert "".join(e for e, _, _ in repaired) == whole["audit"] and row["cost"] == whole["cost"] and row["duplicate"] == whole["duplicate"]
