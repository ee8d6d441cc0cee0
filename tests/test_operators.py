"""Small literal tables: nulls, ties, repeated rows, empty tables, refusals."""

import math

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import names, values
from tablewarden.operators import aggregates, columns, diffs, filters, joins, ledger, loads, privacy, quality, registries, vectors, windows
from tablewarden.plans import steps
from tablewarden.sources import readers, sinks
from tablewarden.streaming import streams


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_flatten_nested(spark):
    df = spark.createDataFrame([(1, ("x", ("y", 2)), [5, 6]), (2, None, None)], "id int, a struct<b: string, c: struct<d: string, e: int>>, l array<int>")
    out = columns.flatten(df)
    assert out.columns == ["id", "a__b", "a__c__d", "a__c__e", "l__0", "l__1"]
    assert rows(out) == [(1, "x", "y", 2, 5, 6), (2, None, None, None, None, None)]


def test_flatten_wide_arrays(spark):
    df = spark.createDataFrame([(1, [(i,) for i in range(70)], list(range(33))), (2, [(7,)], None)], "id int, l array<struct<v: int>>, m array<int>")
    out = columns.flatten(df)
    assert out.columns == ["id", *[f"l__{i}__v" for i in range(70)], *[f"m__{i}" for i in range(33)]]
    assert rows(out) == [(1, *range(70), *range(33)), (2, 7, *[None] * 102)]


def test_flatten_keeps_the_first_of_two_names(spark):
    df = spark.createDataFrame([("first", ("second",))], "a__b string, a struct<b: string>")
    assert rows(columns.flatten(df)) == [("first",)]


def test_sanitise_collisions(spark):
    assert names.sanitise_all(spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-b` int, `!` int")).columns == ["a_b", "a_b_2", "col"]


def test_pii_names():
    found = {r["field"] for r in names.pii_columns(["email", "user_email", "user__email", "Latitude", "amount"])}
    assert found == {"email", "Latitude"}
    assert {r["field"] for r in names.pii_columns(["user__email"], segments=True)} == {"user__email"}


def test_identifiers(spark):
    assert names.check_identifier("a_1") == "a_1"
    for bad in ("", "1a", "a;drop", "a b", "x" * 200):
        with pytest.raises(ValueError):
            names.check_identifier(bad)
    with pytest.raises(ValueError):
        names.check_columns(spark.createDataFrame([(1,)], "`a;b` int"))


def test_coercion(spark):
    df = spark.createDataFrame([("1", "YES"), ("x", "nope"), (None, None)], "a string, b string")
    assert rows(columns.coerce_columns(df, {"a": "int", "b": "bool"})) == [(1, True), (None, None), (None, None)]
    assert rows(columns.coercion_failures(df, {"a": "int", "b": "bool"})) == [("a", 1), ("b", 1)]


@pytest.mark.parametrize("text", ["a + b * 2", "a > 1 and not b == 2", "'x' if a in (1, 2) else 'y'", "a // 2 ** 1", "-a % 3"])
def test_expressions_allowed(spark, text):
    assert columns.derive(spark.createDataFrame([(1, 2)], "a int, b int"), "c", text).count() == 1


@pytest.mark.parametrize("text", ["__import__('os')", "a.b", "(lambda: 1)()", "[x for x in a]", "missing + 1", "a @ b"])
def test_expressions_refused(text):
    with pytest.raises((ValueError, SyntaxError)):
        columns.expression(text, ["a", "b"])


def test_division_by_zero_is_null(spark):
    assert rows(columns.derive(spark.createDataFrame([(1, 0)], "a int, b int"), "c", "a / b").select("c")) == [(None,)]


@pytest.mark.parametrize("number,ok", [("4111111111111111", True), ("4111111111111112", False), ("0", True), ("79927398713", True)])
def test_luhn(spark, number, ok):
    assert spark.range(1).select(values.luhn(F.lit(number))).first()[0] is ok


def test_title_and_phone(spark):
    one = spark.createDataFrame([("o'neil mc2x", "030 1234567")], "a string, b string").select(values.title(F.col("a")), values.phone_e164(F.col("b"), "DE")).first()
    assert tuple(one) == ("O'Neil Mc2X", "+49301234567")


def test_filters_keep_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert rows(filters.filter_rows(df, "x", "neq", "a")) == [("b",), (None,)]
    assert rows(filters.filter_rows(df, "x", "not_in", ["a"])) == [("b",), (None,)]
    with pytest.raises(ValueError):
        filters.filter_rows(df, "x", "like", "a")


def test_marks(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-03",), (None,), ("soon",)], "t string")
    assert rows(filters.above_mark(df, "t", "2024-01-02")) == [("2024-01-03",), ("soon",), (None,)]
    assert rows(filters.late_rows(df, "t", "2024-01-02")) == [("2024-01-01",)]
    numbers = spark.createDataFrame([(1,), (5,)], "n int")
    assert filters.above_mark(numbers, "n", "not a number").count() == 2
    assert filters.above_mark(numbers, "n", None).count() == 2


def test_policies(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert filters.enforce_role(df, {}, None).count() == 0
    with pytest.raises(PermissionError):
        filters.enforce_role(df, {}, "nobody")
    with pytest.raises(PermissionError):
        filters.limit_to_purpose(df, ["x"], reject=True)
    with pytest.raises(PermissionError):
        filters.protocol_gate(df, {"p": {"columns": ["x"], "expires": "2020-01-01"}}, "p", "2024-01-01")
    with pytest.raises(ValueError):
        filters.within_retention(df, "y", "a while", "2024-01-01")


def test_retention_writes(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-01",), ("2024-01-30",)], "t string").withColumn("t", F.col("t").cast("timestamp"))
    out = filters.enforce_retention(df, "t", "30_days", "2024-01-31", f"{tmp_path}/kept", f"{tmp_path}/old")
    assert rows(out) == [("30_days", 2, 1, False)]
    assert spark.read.parquet(f"{tmp_path}/kept").count() == spark.read.parquet(f"{tmp_path}/old").count() == 1


def test_enrich_matches_null_and_renames(spark):
    left = spark.createDataFrame([(1, "l"), (None, "m")], "k int, v string")
    right = spark.createDataFrame([(1, "r1"), (1, "r0"), (None, "n")], "k int, v string")
    assert rows(joins.enrich(left, right, "k", "k", ["v"], [F.col("v")])) == [(1, "l", "r0"), (None, "m", "n")]
    with pytest.raises(ValueError):
        joins.enrich(left, right, "k", "k", ["v"], [])


def test_reference_null_is_violation(spark):
    df, ref = spark.createDataFrame([(1,), (None,), (9,)], "k int"), spark.createDataFrame([("1",)], "k string")
    clean, bad = joins.check_reference(df, "k", ref, "k")
    assert (rows(clean), rows(bad)) == ([(1,)], [(9,), (None,)])


def test_aggregate_drops_null_keys(spark):
    df = spark.createDataFrame([("a", None), (None, 1)], "k string, v int")
    assert rows(aggregates.aggregate(df, ["k"], {"v": "sum"})) == [("a", 0)]


def test_deduplicate_needs_an_order(spark):
    with pytest.raises(ValueError):
        aggregates.deduplicate(spark.range(1), ["id"], "first", [])


def test_anonymity_null_groups(spark):
    df = spark.createDataFrame([("a", "x")] * 5 + [(None, "y")], "q string, s string")
    assert rows(aggregates.risky_groups(df, ["q"], 5)) == [(None, 1)]
    assert aggregates.enforce_anonymity(df, ["q"], 5).count() == 5
    with pytest.raises(ValueError):
        aggregates.enforce_anonymity(df, ["q"], 5, action="raise")
    numbers = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x")], "q int, s string")
    assert rows(aggregates.enforce_anonymity(numbers, ["q"], 1, "s", 2).select("q")) == [(1,), (1,)]


def test_sort_nulls_last(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "x int")
    assert [r[0] for r in windows.sort(df, ["x"], False).collect()] == [2, 1, None]


def test_row_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id int, v string")
    assert rows(diffs.row_diff(old, new, ["id"])) == [(2, "changed", "v", None, "b"), (3, "deleted", None, None, None), (4, "added", None, None, None)]


def test_masks(spark):
    df = spark.createDataFrame([("Ann", None)], "full_name string, email string")
    assert rows(privacy.apply_strategy(df))[0][1] is None
    assert rows(privacy.short_mask(df, ["full_name"]))[0][0] != "Ann"


def test_encryption_keeps_what_it_cannot_read(spark):
    key = b"0123456789abcdef"
    df = spark.createDataFrame([("x",), (None,), ("ENCRYPTED:zzz",)], "s string")
    sealed = privacy.encrypt(df, ["s"], key)
    assert rows(privacy.decrypt(sealed, ["s"], key)) == [("ENCRYPTED:zzz",), ("x",), (None,)]
    assert rows(privacy.decrypt(sealed, ["s"], b"fedcba9876543210")).count(("x",)) == 0


def test_encryption_of_long_texts(spark):
    key = b"0123456789abcdef"
    df = spark.range(3).select("id", F.concat(F.repeat(F.lit("aé"), (1 << 20) + F.col("id").cast("int")), F.lit("end")).alias("s"))
    back = privacy.decrypt(privacy.encrypt(df, ["s"], key), ["s"], key)
    assert back.join(df.withColumnRenamed("s", "t"), "id").filter("s = t").count() == 3


def test_noise_checks(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert rows(privacy.add_noise(df, ["v"], 1.0))[-1] == (None,)
    with pytest.raises(ValueError):
        privacy.add_noise(df, ["v"], 0)
    budget = spark.createDataFrame([("d", 0.9)], "dataset string, epsilon double")
    with pytest.raises(ValueError):
        privacy.spend_budget(budget, "d", 0.2, 1.0)
    assert privacy.spend_budget(budget, "d", 0.1, 1.0).count() == 2


def test_safe_harbour(spark):
    df = spark.createDataFrame([("1", "A B", "03601", 91), (None, "C", " ", None)], "PAT_ID string, PAT_NAME string, ZIP string, AGE int")
    out = privacy.safe_harbour(df)
    assert out.columns == ["PAT_ID", "ZIP", "AGE"]
    assert [tuple(r)[1:] for r in out.collect()] == [("000", "90+"), ("000", None)] and out.collect()[1]["PAT_ID"] == ""
    assert privacy.safe_harbour(df, {"AGE": "drop"}, hash_identifiers=False).columns == ["ZIP"]
    assert privacy.safe_harbour(df.limit(0)).count() == 0


@pytest.mark.parametrize("category,action,names", [(c, a, p.replace(r"\b", "").split("|")) for c, a, p in privacy.SAFE_HARBOUR])
def test_safe_harbour_knows_every_category(category, action, names):
    for n in names:
        assert privacy.safe_harbour_plan([n, n.upper(), f"x {n}"]).keys() == {n, n.upper(), f"x {n}"}, (category, n)
    assert privacy.safe_harbour_plan([names[0]])[names[0]] == action
    assert privacy.safe_harbour_plan(["diagnosis", "heart_rate", "department"]) == {}


def test_quality_score_of_odd_tables(spark):
    names = ("completeness", "uniqueness", "validity", "consistency", "timeliness", "score", "grade")
    one = lambda *a, **k: tuple(quality.quality_score(*a, **k).select(*names).first())
    empty = spark.createDataFrame([], "a int, t timestamp")
    assert one(empty) == (100.0, 100.0, 100.0, 100.0, 100.0, 100.0, "A")
    same = spark.createDataFrame([(5, float("nan")), (5, None), (5, 1.0)], "a int, b double")
    assert one(same)[:4] == (66.67, 100.0, 100.0, 100.0)
    assert one(spark.createDataFrame([("x",), ("x",)], "s string"), passed=1, total=4) == (100.0, 50.0, 25.0, 100.0, 100.0, 71.25, "C")
    stamps = spark.createDataFrame([("2024-01-01", "2020-01-01"), ("2022-01-01", None)], "a string, b string").selectExpr("cast(a as timestamp) a", "cast(b as timestamp) b")
    assert one(stamps, as_of="2024-06-01 00:00:00")[4] == 25.0


def test_null_alerts_of_odd_tables(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "a int, b int")
    assert rows(quality.null_alerts(df, ["a"]).select("column", "alert", "severity", "null_rate")) == [("a", "NULL_FLOOR", "HIGH", 0.6667)]
    assert quality.null_alerts(df).count() == 0 and quality.null_alerts(df.limit(0), ["b"]).count() == 0
    assert rows(quality.null_alerts(df, previous={"a": 0.4}).select("alert", "severity", "previous_rate")) == [("NULL_SPIKE", "MEDIUM", 0.4)]
    assert rows(quality.null_alerts(df, ["gone"]).select("column", "alert")) == [("gone", "NULL_FLOOR")]


def test_contract_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert rows(quality.check_contract(df, {"sla": {"min_rows": 1}, "null_ratio": 0.1}).select("rule", "actual")) == [("min_rows", "0")]
    with pytest.raises(ValueError):
        quality.enforce_contract(df, {"sla": {"min_rows": 1}})


def test_contract_quality_duration_and_rules(spark):
    df = spark.createDataFrame([(1, "5"), (-2, "x"), (None, "nan"), (3, None)], "a int, b string")
    report = spark.createDataFrame([(70.0, 80.0)], "score double, completeness double")
    contract = {"sla": {"max_seconds": 60}, "quality": {"min_score": 75, "min_completeness": 80}, "rules": [{"name": "positive", "column": "a", "condition": "> 0"}, {"name": "not five", "column": "b", "condition": "!= 5"}, {"name": "small", "column": "a", "condition": "<= 3.0"}, {"name": "gone", "column": "c", "condition": "== 1"}]}
    found = quality.check_contract(df, contract, report=report, elapsed=61.04)
    assert rows(found.select("clause", "column", "rule", "actual")) == [("quality", None, "min_score", "70.0"), ("rules", "a", "positive", "1"), ("rules", "b", "not five", "1"), ("rules", "c", "gone", "absent"), ("sla", None, "max_seconds", "61.0")]
    for broken in ({"sla": contract["sla"]}, {"quality": contract["quality"]}, {"rules": contract["rules"][:1]}):
        with pytest.raises(ValueError, match="broken"):
            quality.enforce_contract(df, broken, report=report, elapsed=61)
    assert quality.check_contract(df, {"sla": {"max_seconds": 60}}, elapsed=60).count() == 0
    assert quality.check_contract(df.limit(0), {"rules": contract["rules"][:3]}).count() == 0


@pytest.mark.parametrize("contract", [{"quality": {"min_score": 1}}, {"sla": {"max_seconds": 1}}, {"sla": {"freshness": {"column": "a", "hours": 1}}}, {"qualty": {}}, {"sla": {"min": 1}}, {"quality": {"score": 1}}, {"schema": {"columns": {"absent": {"nul": True}}}}, {"rules": [{"column": "a", "condition": "about 3"}]}, {"rules": [{"condition": "> 3"}]}])
def test_contract_refuses_what_it_cannot_check(spark, contract):
    with pytest.raises(ValueError):
        quality.enforce_contract(spark.createDataFrame([(1,)], "a int"), contract)


def test_score_alerts_of_dimensions(spark):
    df = spark.createDataFrame([("d", "1", 90.0, 100.0, 90.0), ("d", "2", 85.0, 84.0, 75.0), ("d", "3", 84.9, None, 59.0), ("e", "3", 84.0, 0.0, 0.0)], "dataset string, observed_utc string, score double, completeness double, validity double")
    assert rows(quality.score_alerts(df, n=4).select("dataset", "observed_utc", "type", "dimension")) == [("d", "2", "DIMENSION_DROP", "completeness"), ("d", "3", "DIMENSION_DROP", "validity")]


def test_profile_of_all_nulls(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    a, b = quality.profile_columns(df).collect()
    assert (a["nulls"], a["mean"], b["max_length"], b["null_rate"]) == (1, None, None, 1.0)


def test_ledger_tampering(spark):
    log = spark.createDataFrame([(s, i, f"{s}-{i}") for s in range(5) for i in range(4)], "segment_id int, seq int, body string")
    chained = ledger.chain(log).cache()
    heads = ledger.heads(chained)
    sealed = ledger.seal(heads)
    root = sealed.first()["merkle_root"]
    assert ledger.verify_seal(chained, sealed).first()["ok"]
    proofs = ledger.inclusion_proofs(heads)
    assert {r["included"] for r in ledger.check_proof(proofs, root).collect()} == {True}
    assert {r["included"] for r in ledger.check_proof(proofs.withColumn("leaf", F.sha2("leaf", 256)), root).collect()} == {False}
    edits = {
        "edit": chained.withColumn("body", F.when((F.col("segment_id") == 1) & (F.col("seq") == 2), "x").otherwise(F.col("body"))),
        "drop": chained.filter("not (segment_id = 1 and seq = 2)"),
        "drop segment": chained.filter("segment_id <> 4"),
        "rename": chained.withColumn("segment_id", F.when(F.col("segment_id") == 4, 7).otherwise(F.col("segment_id"))),
        "reorder": chained.withColumn("seq", F.when(F.col("segment_id") == 1, 9 - F.col("seq")).otherwise(F.col("seq"))),
    }
    for name, df in edits.items():
        assert not ledger.verify_seal(df, sealed).first()["ok"], name
    assert ledger.seal(heads.limit(0)).first()["merkle_root"] == ledger.EMPTY_ROOT


def test_ledger_blocks(spark):
    log = spark.range(20000).select((F.col("id") % 10 == 0).cast("int").alias("segment_id"), F.col("id").alias("seq"), F.concat(F.lit("b"), F.col("id")).alias("body"))
    assert ledger.chain(log).groupBy("segment_id", "block").count().agg(F.max("count")).first()[0] <= ledger.BLOCK < 18000
    log = spark.createDataFrame([(s, i, f"{s}-{i}") for s in range(3) for i in range(-2, 11)], "segment_id int, seq int, body string")
    chained = ledger.chain(log, block=4).cache()
    assert chained.groupBy("segment_id", "block").count().agg(F.max("count")).first()[0] == 4
    sealed = ledger.seal(ledger.heads(chained))
    assert ledger.verify_seal(chained, sealed).first()["ok"]
    assert {r["entry_count"] for r in ledger.heads(chained).collect()} == {13}
    one = F.col("segment_id") == 1
    edits = [
        (chained.withColumn("body", F.when(one & (F.col("seq") == 4), "x").otherwise(F.col("body"))), [(1, 4, "CONTENT")]),
        (chained.withColumn("self_hash", F.when(one & (F.col("seq") == 3), "x").otherwise(F.col("self_hash"))), [(1, 3, "CONTENT"), (1, 4, "ORDER")]),
        (chained.filter(~one | (F.col("seq") != 4)), [(1, 5, "ORDER")]),
        (chained.filter(~one | (F.col("seq") != 3)), [(1, 4, "ORDER")]),
        (chained.filter(~one | ~F.col("seq").between(4, 7)), [(1, 8, "ORDER")]),
        (chained.filter(~one | (F.col("seq") < 8)), []),
        (chained.filter(~one | (F.col("seq") >= 0)), [(1, 0, "ORDER")]),
    ]
    for df, problems in edits:
        assert rows(ledger.broken_links(df)) == problems
        assert not ledger.verify_seal(df, sealed).first()["ok"]
    assert rows(ledger.truncated(edits[5][0], ledger.heads(chained))) == [(1, 13, 10)]


def test_loads(spark, tmp_path):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "k int, v string")
    assert rows(loads.upsert(a, b, ["k"])) == [(1, "a"), (2, "c"), (2, "d"), (3, "e")]
    with pytest.raises(ValueError):
        loads.upsert(a, b, [])
    assert loads.reconcile(a, b).first()["verdict"] == "EXCESS"
    store = loads.ReversibleLoads(spark, str(tmp_path))
    store.load(a, b, "t", "r1", "2024-01-01")
    assert rows(store.rollback("t", "r1")) == rows(a)
    with pytest.raises(KeyError):
        store.rollback("t", "r2")
    assert store.purge("2025-01-01") == 1
    with pytest.raises(KeyError):
        store.rollback_latest("t")


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], "id long, v array<float>")
    assert [r["id"] for r in vectors.nearest(df, [1.0, 0.1], "v", "id", 3).collect()] == [1, 3, 2]
    for bad in ([], [math.nan], [math.inf]):
        with pytest.raises(ValueError):
            vectors.nearest(df, bad, "v", "id")
    with pytest.raises(ValueError):
        sinks.write_vectors(spark.createDataFrame([(1, [float("nan")])], "id long, v array<double>"), "/tmp/never", "v", "id")


def test_approximate_search_recall(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.filter("vec_id % 50 = 0")
    exact = {(r["query"], r["vec_id"]) for r in vectors.nearest_each(e, q, "embedding", "vec_id", 5).collect()}
    near = {(r["query"], r["vec_id"]) for r in vectors.approximate_nearest(e, q, "embedding", "vec_id", 5).collect()}
    assert len(exact & near) >= 0.9 * len(exact)
    # more bits, as many rows would bring: fewer rows are looked at, recall holds by the neighbouring buckets
    finer = {(r["query"], r["vec_id"]) for r in vectors.approximate_nearest(e, q, "embedding", "vec_id", 5, bucket=e.count() // 64).collect()}
    assert len(exact & finer) >= 0.9 * len(exact)
    assert vectors.approximate_nearest(e.limit(0), q, "embedding", "vec_id", 5).count() == 0


def test_database_in_order(spark, tmp_path):
    url, driver = f"jdbc:derby:memory:{tmp_path.name};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None)], "k int, v string")
    sinks.write_database(df, url, "T", "replace", **driver)
    read = lambda **k: [tuple(r) for r in readers.read_database(spark, url, **k, **driver).collect()]
    want = [(1, "a"), (2, None), (3, "c")]
    assert read(table="T", key="k", ordered=True) == want and read(table="T", ordered=True) == want
    assert read(query='SELECT * FROM T WHERE "k" > 1', key="k", ordered=True) == want[1:]
    with pytest.raises(ValueError):
        sinks.write_database(df, url, "T", "upsert", **driver)


@pytest.mark.parametrize("codec", ["gzip", "bzip2"])
def test_compressed(spark, tmp_path, codec):
    spark.createDataFrame([(1, "a"), (2, None)], "k int, v string").coalesce(1).write.options(header=True, compression=codec).csv(str(tmp_path / "x"))
    file = next((tmp_path / "x").glob("part-*"))
    assert readers.inner_format(str(file)) == "csv" and rows(readers.read(spark, str(file))) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("sql", ["drop table x", "select 1; select 2", "with a as (select 1) insert into b select * from a", "", "set x = 1"])
def test_only_reading_sql(spark, sql):
    with pytest.raises(PermissionError):
        readers.query(spark, {}, sql)


def test_formats():
    assert readers.inner_format("a/b.csv.gz") == "csv"
    assert readers.inner_format("x.NDJSON") == "jsonl"
    with pytest.raises(ValueError):
        readers.inner_format("x.docx")
    assert sinks.writer_of("qdrant") == "vectors"
    with pytest.raises(ValueError):
        sinks.writer_of("nowhere")


def test_steps_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out, notes = steps.run_steps(df, [{"type": "filter", "column": "zz", "op": "eq", "value": 1, "on_error": "warn"}, {"type": "nope"}])
    assert out.count() == 1 and [n["status"] for n in notes] == ["failed", "skipped"]
    with pytest.raises(Exception, match="zz"):
        steps.run_steps(df, [{"type": "filter", "column": "zz", "op": "eq", "value": 1}])


def test_decode_table(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{oops",), (None,)], "value string")
    good, bad = streams.decode(df, spark.createDataFrame([], "a int").schema)
    assert (rows(good), bad.count()) == ([(1,)], 2)


def test_registries(spark):
    df = spark.createDataFrame([("Orders table", "t1"), ("customers", "t2")], "name string, tenant string")
    assert rows(registries.search(df, "orders", ["name"]).select("name")) == [("Orders table",)]
    assert registries.search(df, "orders", ["name"], "t2").count() == 0


def test_upserts_go_on_after_a_failed_batch(spark, tmp_path, monkeypatch):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    files = [[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (1, 3, "d")], [(2, 0, "old"), (3, 1, "e")], [(1, 3, "d2"), (4, None, None)]]
    for f in files:  # one after the other, so that batches come in this order
        spark.createDataFrame(f, "k int, v int, x string").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: streams.upsert_stream(streams.read_stream(spark, source, "k int, v int, x string", per_batch=1), out, checkpoint, ["k"], "v")
    plain, calls = streams.latest, []

    def fails_once(*a):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return plain(*a)

    monkeypatch.setattr(streams, "latest", fails_once)
    with pytest.raises(Exception, match="lost"):
        stream().awaitTermination()
    assert rows(streams.upserted(spark, out, ["k"], "v").select("k", "v")) == [(1, 3), (2, 1)]
    stream().awaitTermination()
    want = [(1, 3, "d2"), (2, 1, "b"), (3, 1, "e"), (4, None, None)]
    assert rows(streams.upserted(spark, out, ["k"], "v")) == want
    stream().awaitTermination()  # nothing new
    streams.compact_upserts(spark, out, str(tmp_path / "folded"), ["k"], "v")
    assert rows(streams.upserted(spark, str(tmp_path / "folded"), ["k"], "v")) == want
    with pytest.raises(ValueError):
        streams.upsert_stream(None, out, checkpoint, [], "v")


# --- selection and ranges ------------------------------------------------------------------------------------


def test_quantiles_are_exact(spark):
    import math
    import random

    from tablewarden.operators import selection

    rng = random.Random(4)
    columns = {
        "same": [3.0] * 999,
        "hot": [1.0] * 700 + [rng.uniform(-1e6, 1e6) for _ in range(299)],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(999)],
        "odd": [math.inf] * 300 + [-math.inf] * 300 + [None] * 99 + [math.nan] * 300,
        "tiny": [5e-324 * rng.randrange(9) for _ in range(999)],
        "none": [None] * 999,
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = selection.quantiles(df, list(columns), probs)
    for c, values in columns.items():
        there = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        for p, q in zip(probs, got[c], strict=True):
            if not there:
                assert q is None
                continue
            at = (len(there) - 1) * p
            a, b = there[math.floor(at)], there[math.ceil(at)]
            want = a if a == b or at == math.floor(at) else a + (b - a) * (at - math.floor(at))
            assert (math.isnan(q) and math.isnan(want)) or q == want, (c, p)
    assert selection.quantiles(df.limit(0), ["same"], [0.5]) == {"same": [None]} and selection.quantiles(df, [], [0.5]) == {}
    counts = {r["column"]: r["distinct"] for r in selection.distinct_counts(df, list(columns)).collect()}
    assert counts == {c: len({"nan" if v != v else v for v in values if v is not None}) for c, values in columns.items()}


def test_no_task_holds_a_column(spark, sf):
    """The plans of a profile have no exact percentile, and no aggregate that gathers values."""
    from tablewarden.operators import quality

    plan = quality.column_statistics(spark.read.parquet(f"{sf}/lineitem.parquet"))._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan and "collect_" not in plan


@pytest.mark.parametrize("ranges", [1, 3, 16])
@pytest.mark.parametrize("how", ["forward", "backward"])
def test_fills_along_ranges(spark, how, ranges):
    import random

    from tablewarden.operators import ranges as scans

    rng = random.Random(ranges)
    rows = [(i, rng.choice([None, "a", "a", "a", "b"]), rng.choice([0, 0, 0, i]), rng.choice([None, None, None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, k string, t long, v long").repartition(5)
    order = [F.col("t").desc(), F.col("i")]
    for by in ([], ["k"]):
        got = {r["i"]: r["v"] for r in scans.fill_ranges(df, ["v"], how, order, by, ranges).collect()}
        carried = {}
        want = {}
        for i, k, t, v in sorted(rows, key=lambda r: (-r[2], r[0]), reverse=how == "backward"):
            key = k if by else 0
            carried[key] = v if v is not None else carried.get(key)
            want[i] = carried[key]
        assert got == want
    assert scans.fill_ranges(df.limit(0), ["v"], how, order).count() == 0


def test_places_split_a_value_that_many_rows_share(spark):
    from tablewarden.operators import ranges as scans

    df = spark.createDataFrame([(i, 7 if i % 10 else i) for i in range(1000)], "i long, v long").repartition(4)
    rows = scans.number_rows(df, [F.col("v")], "n", 8).collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 1001))
    assert [r["v"] for r in sorted(rows, key=lambda r: r["n"])] == sorted(r["v"] for r in rows)
    sizes = [r["count"] for r in scans.ranged(df, [F.col("v")], 8).groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 400
    assert scans.number_rows(df.limit(0), [F.col("v")]).count() == 0


# --- kept vector index ---------------------------------------------------------------------------------------


def test_vector_index(spark, tmp_path):
    import numpy as np

    from tablewarden.operators import vector_index

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16)) * 3
    x = np.concatenate([centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16)) * 0.5, np.ones((1500, 16))])
    df = spark.createDataFrame([(i, v.tolist(), "own") for i, v in enumerate(x)], "id long, v array<double>, list string").repartition(6)
    asked = df.filter("id % 50 = 0")
    for kind in ("cosine", "l2"):
        path = str(tmp_path / kind)
        vector_index.build_index(df, "v", "id", path, kind)
        exact = {(r["query"], round(r["distance"], 9)) for r in vectors.nearest_each(df, asked, "v", "id", 10, kind).collect()}
        rows = vector_index.search_index(spark, path, asked, "v", "id", 10).collect()
        assert len(rows) == 900 and all(r["query"] != r["id"] for r in rows)
        found = {(r["query"], round(r["distance"], 9)) for r in rows}
        assert len(exact & found) >= 0.9 * len(exact)
        read = vector_index.rows_read(spark, path, vector_index.probed(spark, path, asked, "v", "id")).collect()
        # a third of the rows are one vector, in one list
        assert sum(r["rows_read"] < 0.6 * r["rows"] for r in read) > 0.9 * len(read)
        plan = vector_index.search_index(spark, path, asked.filter("id = 50"), "v", "id", 10, probes=1)._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(list" in plan or "PartitionFilters: [list" in plan
    empty = str(tmp_path / "none")
    vector_index.build_index(df.limit(0), "v", "id", empty)
    assert vector_index.search_index(spark, empty, asked, "v", "id").count() == 0
    with pytest.raises(ValueError):
        vector_index.build_index(spark.createDataFrame([(1, [1.0, math.nan])], "id long, v array<double>"), "v", "id", str(tmp_path / "bad"))


# --- commits, noise, observed streams ------------------------------------------------------------------------


def test_two_writers_get_two_versions(spark, tmp_path):
    """Eight snapshots of one dataset at once: versions 1 to 8, none lost, all readable."""
    from concurrent.futures import ThreadPoolExecutor

    stores = [loads.SnapshotStore(spark, str(tmp_path)) for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda i: stores[i].snapshot(spark.range(i + 1), "d", at=str(i)), range(8)))
    assert sorted(versions) == list(range(1, 9))
    assert {v: stores[0].checkout("d", v).count() for v in versions} == {v: i + 1 for i, v in enumerate(versions)}
    log = stores[0].log
    assert [r["_commit"] for r in log.entries().orderBy("_commit").collect()] == list(range(1, 9))
    assert not log.put(3, {"dataset": "x"}) and log.entries().filter("dataset = 'x'").count() == 0
    stores[0].delete("d", 8)
    assert stores[1].snapshot(spark.range(99), "d") == 9 and stores[2].snapshot(spark.range(99), "d") == 9


def test_budget_is_not_overspent(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    df = spark.createDataFrame([(1.0,), (5.0,)], "v double")

    def ask(_):
        try:
            privacy.add_noise(df, ["v"], 0.4, budget=privacy.PrivacyBudget(spark, str(tmp_path)), dataset="d", cap=1.0)
        except ValueError:
            return False
        return True

    with ThreadPoolExecutor(5) as pool:
        assert sum(pool.map(ask, range(5))) == 2
    assert privacy.PrivacyBudget(spark, str(tmp_path)).spent("d") == pytest.approx(0.8)


def test_noise_is_fresh_and_on_a_grid(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") * 0.1).alias("v"))
    a, b = ([r["v"] for r in privacy.add_noise(df, ["v"], 1.0, clip=False).orderBy("id").collect()] for _ in range(2))
    assert sum(x != y for x, y in zip(a, b, strict=True)) > 1900
    grid = 2.0**-10
    assert all(x / grid == round(x / grid) for x in a)
    c, d = ([r["v"] for r in privacy.add_noise(df, ["v"], 1.0, clip=False, seed=1).orderBy("id").collect()] for _ in range(2))
    assert c == d
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert any(r["v"] != 3.0 for _ in range(3) for r in privacy.add_noise(same, ["v"], 0.1).collect())


def test_a_stream_that_failed_ends_as_one_that_did_not(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, f"a{i}@x.org", None if i % 3 else float(i)) for i in range(40)], "id long, email string, v double")
    source = str(tmp_path / "in")
    for i in range(4):
        rows.filter(F.col("id") % 4 == i).coalesce(1).write.mode("append").parquet(source)
    read = lambda: streams.read_stream(spark, source, rows.schema, per_batch=1)
    whole, failed = str(tmp_path / "whole"), str(tmp_path / "failed")
    streams.govern_observed_stream(read(), whole, str(tmp_path / "c1"), "r", "2024-01-01", "d").awaitTermination()
    chain, calls = streams.ledger.chain, []

    def once(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return chain(df)

    monkeypatch.setattr(streams.ledger, "chain", once)
    with pytest.raises(Exception, match="lost"):
        streams.govern_observed_stream(read(), failed, str(tmp_path / "c2"), "r", "2024-01-01", "d").awaitTermination()
    assert spark.read.parquet(f"{failed}/rows").select("batch").distinct().count() == 2 and spark.read.parquet(f"{failed}/events").select("batch").distinct().count() == 1
    streams.govern_observed_stream(read(), failed, str(tmp_path / "c2"), "r", "2024-01-01", "d").awaitTermination()
    for part in ("rows", "observations", "events"):
        a, b = (spark.read.parquet(f"{x}/{part}") for x in (whole, failed))
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    assert ledger.broken_links(spark.read.parquet(f"{failed}/events")).count() == 0


def test_breach_signals_of_what_is_not_known(spark):
    loads_ = spark.createDataFrame([("new", 1, ["email"], ["a"], None, None, None), ("empty", None, None, None, None, None, None)], "dataset string, rows long, pii_fields array<string>, columns array<string>, quality double, country string, erased long")
    known = spark.createDataFrame([("empty", None, None, None)], "dataset string, columns array<string>, pii_fields array<string>, countries array<string>")
    assert rows(privacy.breach_signals(loads_, known)) == [("new", "FIRST_PII_LOAD", "MEDIUM", None)]


def test_drift_of_small_numbers(spark):
    a = spark.createDataFrame([(1e-7,), (2e-7,)], "v double")
    b = spark.createDataFrame([(5e-7,), (6e-7,)], "v double")
    stats = lambda df: quality.column_statistics(df, digits=None, parts=("numbers",))
    assert quality.mean_drift(stats(b), stats(a)).first()["severity"] == "HIGH"
    assert quality.mean_drift(stats(a.limit(0)), stats(a)).count() == 0


# --- lineage, search -----------------------------------------------------------------------------------------


def test_column_lineage(spark):
    from tablewarden.operators import lineage

    a = spark.createDataFrame([(1, "x", "m@x.org")], "id long, kind string, email string")
    b = spark.createDataFrame([(1, 2.0)], "id long, v double")
    df = a.join(b, "id").withColumn("hidden", F.sha2("email", 256)).drop("email").withColumnRenamed("v", "value")
    df = df.unionByName(df.limit(0)).groupBy("id", "hidden").agg(F.sum("value").alias("value"))
    got = {(r["source"], r["column"], r["target"], r["how"]) for r in lineage.column_lineage(df, {"a": a, "b": b}).collect()}
    assert got == {("a", "id", "id", "copied"), ("a", "email", "hidden", "derived"), ("b", "v", "value", "derived"), ("a", "kind", None, "dropped"), ("b", "id", None, "dropped")}
    assert {r["pii"] for r in lineage.column_lineage(df, {"a": a, "b": b}).collect() if r["column"] == "email"} != {None}
    twice = a.alias("p").join(a.alias("q"), F.col("p.id") == F.col("q.id")).select(F.col("q.kind").alias("kind"))
    assert {(r["column"], r["how"]) for r in lineage.column_lineage(twice, {"a": a}).collect() if r["target"]} == {("kind", "copied")}
    assert lineage.with_values(lineage.column_lineage(df.limit(0)), df.limit(0)).filter("values > 0").count() == 0


def test_ranked_search(spark, tmp_path):
    rows_ = [(1, "red fish, blue fish", None), (2, "blue sky", "red"), (3, None, None), (4, "", "x"), (5, "naïve Größe", "fish red")]
    df = spark.createDataFrame(rows_, "id long, a string, b string")
    path = str(tmp_path / "index")
    registries.build_search_index(df, "id", ["a", "b"], path)
    find = lambda q, **how: [(r["key"], r["terms"]) for r in registries.search_index(spark, path, q, **how).orderBy(F.desc("score"), "key").collect()]
    assert find("fish") == [(1, 1), (5, 1)] and {k for k, n in find("RED fish") if n == 2} == {1, 5}
    assert [k for k, _ in find("red fish", phrase=True)] == [1] and [k for k, _ in find("GRÖSSE größe")] == [5]
    assert [k for k, _ in find("ïv")] == [5] and find("") == [] and find("zebra") == []
    registries.build_search_index(df.limit(0), "id", ["a", "b"], path)
    assert find("fish") == []


# --- archives, databases by key ------------------------------------------------------------------------------


def test_archives(spark, tmp_path):
    import gzip
    import io
    import tarfile
    import zipfile

    from tablewarden.sources import archives

    a = 'id,text\n1,"two\nlines, and a comma"\n2,\n'
    b = '{"id": 3, "text": "x"}\nbroken\n\n{"id": "four", "text": null}\n'
    c = gzip.compress("text\tid\ny\t5\n".encode())
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        for name, body in (("a.csv", a), ("d/b.jsonl", b), ("c.tsv.gz", c), ("readme.bin", "?"), ("e.csv", "")):
            z.writestr(name, body)
    with tarfile.open(tmp_path / "y.tgz", "w:gz") as t:
        for name, body in (("a.csv", a.encode()), ("b.csv", b"id,text\n6,z\n")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("id", LongType()), StructField("text", StringType())])
    got = archives.read_archives(spark, str(tmp_path / "x.zip"), schema=schema)
    assert got.rdd.getNumPartitions() == 4
    want = [(1, "two\nlines, and a comma", "a.csv"), (2, None, "a.csv"), (3, "x", "d/b.jsonl"), (None, None, "d/b.jsonl"), (None, None, "d/b.jsonl"), (5, "y", "c.tsv.gz")]
    assert sorted(rows(got), key=str) == sorted(want, key=str)
    tar = archives.read_archives(spark, f"file://{tmp_path}/y.tgz")
    assert tar.columns == ["id", "text", "_member"] and tar.rdd.getNumPartitions() == 2 and sorted(r["id"] for r in tar.collect()) == ["1", "2", "6"]
    assert archives.read_archives(spark, str(tmp_path), schema=schema).count() == 9
    with pytest.raises(ValueError):
        archives.members(str(tmp_path / "x.csv"))


def test_database_by_key(spark, tmp_path):
    from tablewarden.sources import keyed

    url, driver = f"jdbc:derby:memory:t{abs(hash(str(tmp_path)))};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows_ = [(f"k'{i % 7}", i // 7 if i % 11 else None, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows_, "a string, b int, v double")
    sinks.write_database(df, url, "T", "replace", **driver, createTableColumnTypes="a VARCHAR(20)")
    assert keyed.primary_key(spark, url, "T", **driver) == []
    for key in (["a", "b"], ["a"], ["v"], []):
        got = keyed.read_keyed(spark, url, "T", key, partitions=5, **driver)
        assert sorted(rows(got), key=str) == sorted(rows_, key=str)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 4
    first = keyed.read_keyed(spark, url, "T", ["a", "b"], where='"v" < 150', partitions=3, **driver)
    done = keyed.last_key(first, ["a", "b"])
    rest = keyed.read_keyed(spark, url, "T", ["a", "b"], partitions=3, resume_after=done, **driver)
    assert all((r["a"], r["b"]) > done for r in rest.collect())
    assert rest.count() == sum(b is not None and (a, b) > done for a, b, _ in rows_)
    sinks.write_database(df.limit(0), url, "EMPTY", "replace", **driver, createTableColumnTypes="a VARCHAR(20)")
    assert keyed.read_keyed(spark, url, "EMPTY", ["a"], **driver).count() == 0
    assert keyed.literal("it's") == "'it''s'"
    with pytest.raises(TypeError):
        keyed.literal(b"x")


def test_nearest_by_both_ways(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 8)), np.ones((200, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(4)
    asked = df.filter("id % 7 = 0")
    for kind in ("cosine", "l2", "inner"):
        a, b = (sorted((r["query"], r["rank"], r["id"], round(r["distance"], 9)) for r in vectors.nearest_each(df, asked, "v", "id", 6, kind, block=16, rows=64, sent=s).collect()) for s in (1 << 20, 0))
        assert a == b and len(a) == 6 * asked.count()
    assert vectors.nearest_each(df.limit(0), asked, "v", "id").count() == 0 and vectors.nearest_each(df, asked.limit(0), "v", "id").count() == 0


def test_fingerprints_of_ranges(spark, tmp_path):
    import hashlib

    from tablewarden.sources import ranges as parts

    body = bytes(range(256)) * 100
    for name, data in (("a", body), ("b", body), ("c", body[:-1]), ("empty", b"")):
        (tmp_path / name).write_bytes(data)
    got = {r["file"]: r for r in parts.large_fingerprints(spark, f"file:{tmp_path}", 1000).collect()}
    assert {n: (r["bytes"], r["ranges"]) for n, r in got.items()} == {"a": (25600, 26), "b": (25600, 26), "c": (25599, 26), "empty": (0, 0)}
    assert got["a"]["sha256"] == hashlib.sha256(body).hexdigest() and got["empty"]["sha256"] == hashlib.sha256(b"").hexdigest()
    assert got["a"]["tree"] == got["b"]["tree"] and len({got[n]["tree"] for n in ("a", "c", "empty")}) == 3
    assert parts.hash_ranges(spark, str(tmp_path / "a"), 1000).rdd.getNumPartitions() == 26
    with pytest.raises(Exception, match="FileNotFoundError"):
        parts.hash_ranges(spark, str(tmp_path / "none")).collect()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 13])
def test_root_of_one_row_is_the_root_of_levels(spark, monkeypatch, n):
    heads = spark.createDataFrame([(i, i + 1, f"h{i}") for i in range(n)], "segment_id long, entry_count long, last_hash string")
    one = ledger.seal(heads).first()
    monkeypatch.setattr(ledger, "FOLD", -1)
    if n:
        assert one == ledger.seal(heads).first()
    else:
        assert one["merkle_root"] == ledger.EMPTY_ROOT


def test_noise_is_as_wide_as_its_law(spark):
    df = spark.range(20_000).select(F.lit(5.0).alias("v"))
    for how, mean in (("laplace", 100.0), ("gaussian", 100.0 * (2 * math.log(1.25e5)) ** 0.5 * (2 / math.pi) ** 0.5)):
        x = privacy.add_noise(df, ["v"], 0.01, 1.0, how, clip=False, seed=5).select(F.avg(F.abs(F.col("v") - 5.0)).alias("m")).first()["m"]
        assert abs(x / mean - 1) < 0.03


def test_database_in_a_file(spark, tmp_path):
    from tablewarden.sources import keyed

    url = f"sqlite:file://{tmp_path}/db"
    rows_ = [(f"k'{i % 7}", i // 7 if i % 11 else None, float(i), i % 2 == 0) for i in range(300)]
    df = spark.createDataFrame(rows_, "a string, b int, v double, f boolean").repartition(3)
    sinks.write_database(df, url, "T", "replace")
    for key in (["a", "b"], ["v"], []):
        assert sorted(rows(keyed.read_keyed(spark, url, "T", key, partitions=5)), key=str) == sorted(rows_, key=str)
    for key in ("b", None):
        got = readers.read_database(spark, url, "T", columns=["v"], where="v < 150", key=key, partitions=4)
        assert rows(got) == sorted([(float(i),) for i in range(150)], key=repr)
    sinks.write_database(df.filter("v < 10").withColumn("a", F.lit("new")), url, "T", "upsert", keys=["v"])
    sinks.write_database(df.filter("v = 20"), url, "T", "append")
    again = readers.read_database(spark, url, "T")
    assert again.count() == 301 and again.filter("a = 'new'").count() == 10 and again.schema == df.schema
    sinks.write_database(df.dropna(), url, "K", "replace", primary=["a", "b"])
    assert keyed.primary_key(spark, url, "K") == ["a", "b"]
    with pytest.raises(Exception, match="UNIQUE"):
        sinks.write_database(df.dropna().limit(1), url, "K", "append")
    assert readers.read_database(spark, url, "K").count() == df.dropna().count()
    sinks.write_database(df.limit(0), url, "E", "replace")
    assert keyed.read_keyed(spark, url, "E", ["v"]).count() == 0
    with pytest.raises(TypeError):
        sinks.write_database(spark.sql("select current_date() as d"), url, "D")


def test_database_queries_use_no_database_of_one_process():
    import inspect

    from tablewarden.queries import loading

    assert "derby:memory" not in inspect.getsource(loading)


def test_small_ranges_of_a_file_share_a_task(spark, tmp_path):
    import hashlib

    from tablewarden.sources import ranges

    data = bytes(range(256)) * 400 + b"rest"
    (tmp_path / "x").write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    found = ranges.hash_ranges(spark, str(tmp_path), 10)
    assert found.rdd.getNumPartitions() == 65
    got = {r["at"]: (r["bytes"], r["sha256"]) for r in found.filter("size > 0").collect()}
    assert got == {i: (len(data[i : i + 10]), hashlib.sha256(data[i : i + 10]).hexdigest()) for i in range(0, len(data), 10)}
    whole = {r["file"]: (r["bytes"], r["ranges"], r["sha256"]) for r in ranges.large_fingerprints(spark, str(tmp_path), 10).collect()}
    assert whole == {"x": (len(data), len(got), hashlib.sha256(data).hexdigest()), "empty": (0, 0, hashlib.sha256(b"").hexdigest())}


def test_latest_rows_are_dealt_out_before_keys_are_held(spark):
    df = spark.createDataFrame([(i % 5, i, f"x{i}") for i in range(50)], "k int, v int, x string").coalesce(1)
    found = streams.latest(df, ["k"], ["v"])
    assert rows(found) == [(i, 45 + i, f"x{45 + i}") for i in range(5)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("partial_max_by") < plan.rindex("Repartition" if "Repartition" in plan else "Exchange")


def test_approximate_search_joins_no_pairs(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = vectors.approximate_nearest(e, e.filter("vec_id % 50 = 0"), "embedding", "vec_id", 5)
    assert found.columns == ["query", "vec_id", "distance", "rank"]
    # blocks of lists meet blocks of queries; vectors are not joined to pairs afterwards
    assert found._jdf.queryExecution().sparkPlan().toString().count("Join") == 1
