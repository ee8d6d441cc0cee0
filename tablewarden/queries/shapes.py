"""Clinical mappings (OM) and registries (REG)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import health, registries
from .registry import query

_S = "CAST({} AS VARCHAR)"


def _concepts(t, column: str, vocabulary: str):
    return t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("source_code"), F.lit(vocabulary).alias("source_vocabulary_id"), (F.col("p_partkey") * 10).cast("int").alias("concept_id"))


@query("om1_person", "SELECT CAST(c_custkey AS VARCHAR) AS person_source_value, CASE c_custkey % 3 WHEN 1 THEN 8532 WHEN 2 THEN 8507 ELSE 0 END AS gender_concept_id, CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1960 END AS year_of_birth, CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE CAST(1 + c_custkey % 12 AS INTEGER) END AS month_of_birth FROM customer")
def _(t):
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("PAT_ID"), (F.col("c_custkey") % 3).cast("string").alias("SEX_C"), F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("1960-"), F.lpad((1 + F.col("c_custkey") % 12).cast("string"), 2, "0"), F.lit("-15"))).alias("BIRTH_DATE"), F.lit("1").alias("PATIENT_RACE_C"), F.lit("9").alias("ETHNIC_GROUP_C"))
    return health.person(rows).select("person_source_value", "gender_concept_id", "year_of_birth", "month_of_birth")


@query("om2_visits", "SELECT CAST(o_orderkey AS VARCHAR) AS visit_source_value, CASE o_orderkey % 4 WHEN 0 THEN 9201 WHEN 1 THEN 9202 WHEN 2 THEN 9203 ELSE 9201 END AS visit_concept_id, CAST(o_orderdate AS DATE) AS visit_start_date FROM orders")
def _(t):
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("PAT_ENC_CSN_ID"), F.col("o_custkey").cast("string").alias("PAT_ID"), F.col("o_orderdate").cast("string").alias("CONTACT_DATE"), F.expr("case o_orderkey % 4 when 0 then '101' when 1 then '102' when 2 then '103' else '999' end").alias("ADT_PAT_CLASS_C"), F.lit(None).cast("string").alias("HOSP_DISCH_TIME"), F.lit("p").alias("VISIT_PROV_ID"))
    return health.visit_occurrence(rows).select("visit_source_value", "visit_concept_id", "visit_start_date")


def _line(t):
    k = F.col("l_partkey").cast("string")
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("PAT_ENC_CSN_ID"), F.col("l_suppkey").cast("string").alias("PAT_ID"), F.col("l_linenumber").alias("LINE"), k.alias("code"),
        F.when(F.col("l_linenumber") % 2 == 0, k).otherwise(" ").alias("CURRENT_ICD10_LIST"), k.alias("CURRENT_ICD9_LIST"), F.when(F.col("l_linenumber") == 1, "Y").otherwise("N").alias("PRIMARY_DX_YN"),
        F.col("l_shipdate").cast("string").alias("CONTACT_DATE"), F.when(F.col("l_linenumber") % 3 == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("amount"),
    )


@query("om3_conditions", "SELECT CAST(l_orderkey AS VARCHAR) AS visit_source_value, CAST(l_partkey AS VARCHAR) AS condition_source_value, CASE WHEN l_partkey % 2 = 0 AND l_linenumber % 2 = 0 THEN CAST(l_partkey * 10 AS INTEGER) ELSE 0 END AS condition_concept_id, CASE WHEN l_linenumber = 1 THEN 32902 ELSE 32908 END AS condition_type_concept_id FROM lineitem")
def _(t):
    return health.condition_occurrence(_line(t), _concepts(t, "code", "ICD10CM")).select("visit_source_value", "condition_source_value", "condition_concept_id", "condition_type_concept_id")


@query("om4_drugs", "SELECT CAST(l_orderkey AS VARCHAR) AS visit_source_value, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey * 10 AS INTEGER) ELSE 0 END AS drug_concept_id, CASE WHEN l_linenumber % 3 <> 0 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS quantity FROM lineitem")
def _(t):
    rows = _line(t).select(F.concat_ws("-", "PAT_ENC_CSN_ID", "LINE").alias("ORDER_MED_ID"), "PAT_ID", "PAT_ENC_CSN_ID", F.col("code").alias("MEDICATION_ID"), F.col("CONTACT_DATE").alias("ORDERING_DATE"), F.col("amount").alias("QUANTITY"), F.lit("daily").alias("SIG"))
    return health.drug_exposure(rows, _concepts(t, "code", "RxNorm")).select("visit_source_value", "drug_concept_id", "quantity")


@query("om5_measurements", "SELECT CAST(l_partkey AS VARCHAR) AS measurement_source_value, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey * 10 AS INTEGER) ELSE 0 END AS measurement_concept_id, CASE WHEN l_linenumber % 3 <> 0 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS value_as_number, CAST(1.5 AS DOUBLE) AS range_low FROM lineitem")
def _(t):
    rows = _line(t).select(F.col("PAT_ENC_CSN_ID").alias("RESULT_ID"), "PAT_ID", "PAT_ENC_CSN_ID", F.col("code").alias("COMPONENT_ID"), F.col("CONTACT_DATE").alias("RESULT_DATE"), F.col("amount").alias("ORD_VALUE"), F.lit("1.5").alias("REFERENCE_LOW"), F.lit("high").alias("REFERENCE_HIGH"))
    return health.measurement(rows, _concepts(t, "code", "LOINC")).select("measurement_source_value", "measurement_concept_id", "value_as_number", "range_low")


@query("om6_procedures", "SELECT CAST(l_partkey AS VARCHAR) AS procedure_source_value, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey * 10 AS INTEGER) ELSE 0 END AS procedure_concept_id, CAST(l_shipdate AS DATE) AS procedure_date FROM lineitem")
def _(t):
    rows = _line(t).select(F.col("PAT_ENC_CSN_ID").alias("ORDER_PROC_ID"), "PAT_ID", "PAT_ENC_CSN_ID", F.col("code").alias("PROC_CODE"), F.col("CONTACT_DATE").alias("ORDERING_DATE"))
    return health.procedure_occurrence(rows, _concepts(t, "code", "CPT4")).select("procedure_source_value", "procedure_concept_id", "procedure_date")


@query("om7_extract", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 4)")
def _(t):
    return health.extract(t.orders, "o_orderdate", "1995-01-01", "1996-12-31", "o_custkey", t.customer.filter("c_nationkey = 4").select("c_custkey"), ["o_orderkey", "o_custkey"])


@query("reg1_agreements", "SELECT CAST(s_suppkey AS VARCHAR) AS load_id, CASE s_suppkey % 4 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'EXPIRED' WHEN 2 THEN 'EXPIRING' ELSE 'ACTIVE' END AS status, CASE WHEN s_suppkey % 4 = 0 THEN 'email,ssn' ELSE 'ssn' END AS uncovered FROM supplier")
def _(t):
    party = F.col("s_suppkey").cast("string")
    loads = t.supplier.select(party.alias("load_id"), party.alias("party"), F.array(F.lit("email"), F.lit("ssn")).alias("data_types"))
    held = t.supplier.filter("s_suppkey % 4 <> 0").select(party.alias("party"), F.expr("case s_suppkey % 4 when 1 then '2024-05-01' when 2 then '2024-06-20' else '2025-06-01' end").alias("expires"), F.array(F.lit("email")).alias("data_types"))
    return registries.check_agreements(loads, held, "2024-06-01").select("load_id", "status", "uncovered")


@query("reg1_overdue_reviews", "SELECT s_name AS vendor, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(517 AS INTEGER) END AS days FROM supplier WHERE s_suppkey % 3 <> 2")
def _(t):
    vendors = t.supplier.select(F.col("s_name").alias("vendor"), F.lit("HIGH").alias("risk"), F.expr("case s_suppkey % 3 when 1 then '2023-01-01' when 2 then '2024-05-01' end").alias("last_review"), F.lit(False).alias("has_dpa"))
    return registries.overdue_reviews(vendors, "2024-06-01").select("vendor", "days")


@query("reg2_controls", "SELECT 'balances' AS control, CASE WHEN count(*) FILTER (c_acctbal < 0) > 0 THEN 'FAIL' ELSE 'OK' END AS status FROM customer UNION ALL SELECT 'orders', CASE WHEN count(*) FILTER (o_totalprice > 1) > 0 THEN 'WARN' ELSE 'OK' END FROM orders")
def _(t):
    return registries.control_summary({"balances": t.customer.agg(F.count_if(F.col("c_acctbal") < 0).alias("bad"), F.lit(0).alias("warn")), "orders": t.orders.agg(F.lit(0).alias("bad"), F.count_if(F.col("o_totalprice") > 1).alias("warn"))})


@query("reg3_inventory", "SELECT table_name AS dataset, column_name AS \"column\" FROM (DESCRIBE customer) d, (SELECT 'customer' AS table_name) UNION ALL SELECT 'region', column_name FROM (DESCRIBE region)")
def _(t):
    return registries.inventory({"customer": t.customer, "region": t.region}, {"customer": {"owner": "sales"}})[1].select("dataset", "column")


@query("reg4_search", "SELECT p_partkey, CAST(contains(lower(p_name || ' ' || p_type), w1) AS INTEGER) + CAST(contains(lower(p_name || ' ' || p_type), 'standard') AS INTEGER) AS hits FROM (SELECT *, 'part' AS w1 FROM part) WHERE contains(lower(p_name || ' ' || p_type), w1) OR contains(lower(p_name || ' ' || p_type), 'standard')")
def _(t):
    return registries.search(t.part, "Part standard", ["p_name", "p_type"]).select("p_partkey", "hits")


_RANKED = """
WITH w AS (SELECT p_partkey AS key, p_size, unnest(regexp_extract_all(lower(p_name || ' ' || p_type || ' ' || p_brand), '[\\p{L}\\p{N}]+')) AS term FROM part),
l AS (SELECT key, count(*) AS length FROM w GROUP BY key), s AS (SELECT count(*) AS n, avg(length) AS mean FROM l),
c AS (SELECT key, term, count(*) AS c FROM w WHERE term IN ('standard', 'brand', 'bolt', '5') GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM c GROUP BY term)
SELECT key, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score, CAST(count(*) AS INTEGER) AS terms, count(*) = 4 AS all_terms
FROM c JOIN d USING (term) JOIN l USING (key), s GROUP BY key"""


@query("reg4_ranked", _RANKED)
def _(t):
    path = t.folder()
    registries.build_search_index(t.part, "p_partkey", ["p_name", "p_type", "p_brand"], path)
    return registries.search_index(t.spark, path, "Standard bolt, BRAND#5")


@query("reg4_phrase", "SELECT p_partkey AS key, true AS all_terms FROM part WHERE contains(' ' || lower(p_type || ' ' || p_name || ' ' || p_name) || ' ', ' ' || (SELECT lower(min(p_name)) FROM part) || ' ')")
def _(t):
    """Texts in which the words of the first name stand one after the other."""
    path = t.folder()
    registries.build_search_index(t.part, "p_partkey", ["p_type", "p_name", "p_name"], path)
    return registries.search_index(t.spark, path, t.part.agg(F.min("p_name")).first()[0], phrase=True).select("key", "all_terms")


@query("reg4_fallback", "SELECT p_partkey AS key, 0.0 AS score FROM part WHERE contains(lower(p_name || ' ' || p_type), 'tandar')")
def _(t):
    """No text holds the term, so parts of words are looked for."""
    path = t.folder()
    registries.build_search_index(t.part, "p_partkey", ["p_name", "p_type"], path)
    return registries.search_index(t.spark, path, "TANDAR").select("key", "score")


def _models(t):
    m = t.orders.groupBy(F.col("o_orderstatus").alias("model"), (F.col("o_orderkey") % 2).cast("int").alias("version")).agg(F.count("*").cast("double").alias("n"), F.max("o_custkey").cast("double").alias("m"))
    return m.select("model", "version", F.array(F.lit("orders"), F.col("model")).alias("datasets"), F.create_map(F.lit("rows"), F.col("n"), F.lit("largest"), F.col("m")).alias("metrics"))


@query("reg5_impact", "SELECT DISTINCT o_orderstatus AS model, CAST(o_orderkey % 2 AS INTEGER) AS version FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return registries.model_impact(_models(t), "F")


@query("reg5_compare", "SELECT 'rows' AS metric, CAST(count(*) FILTER (o_orderkey % 2 = 0) AS DOUBLE) AS a, CAST(count(*) FILTER (o_orderkey % 2 = 1) AS DOUBLE) AS b FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'largest', CAST(max(o_custkey) FILTER (o_orderkey % 2 = 0) AS DOUBLE), CAST(max(o_custkey) FILTER (o_orderkey % 2 = 1) AS DOUBLE) FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return registries.compare_models(_models(t), "F", 0, 1).select("metric", "a", "b")


@query("reg6_import_policies", "SELECT r_name AS source_label, CAST(count(*) AS BIGINT) AS row_count FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name")
def _(t):
    path = t.folder()
    rows = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").count()
    doc = json.dumps({"datasets": [{"source_label": r["r_name"], "columns": ["a"], "dtypes": {"a": "long"}, "column_purposes": {"a": ["x"]}, "pii_columns": [], "allowed_columns": ["a"], "purpose": "x", "expected_row_count": n, "null_rates": {"a": 0.0}} for r in rows.collect() for n in (0, r["count"])]})  # one row a region
    t.spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    return registries.import_policies(t.spark, path)["baseline"].select("source_label", "row_count")
