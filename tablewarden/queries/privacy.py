"""Privacy (PV) and noisy aggregates (AG9)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import names
from ..functions.values import mask
from ..operators import aggregates, privacy
from .registry import query

_KEY = b"0123456789abcdef"
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _people(t):
    """Customers as people, with e-mail, phone, card, birth and place columns."""
    c = F.col("c_custkey")
    n = F.lpad((c % 10000).cast("string"), 4, "0")
    return t.customer.select(
        c.alias("id"),
        F.col("c_name").alias("full_name"),
        F.when(c % 10 != 0, F.concat(F.lit("user"), c.cast("string"), F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("call 415-555-"), n, F.lit(" or "), F.lit("123-45-"), n).alias("comment"),
        F.when(c % 2 == 0, "card 4111 1111 1111 1111").otherwise("card 4111 1111 1111 1112").alias("note"),
        (c % 100).alias("age"),
        F.concat(F.lpad((c * 37 % 1000).cast("string"), 3, "0"), F.lit("12")).alias("zip"),
        F.date_format(F.date_add(F.lit("1950-01-01"), (c % 20000).cast("int")), "yyyy-MM-dd").alias("birth_date"),
        F.col("c_acctbal").alias("balance"),
        "c_mktsegment",
    )


@query("pv1_pii_columns", "SELECT * FROM (VALUES ('full_name', 'name', false), ('email', 'email', false), ('age', 'age', false), ('zip', 'postcode', false), ('birth_date', 'birth', false)) v(field, kind, special) WHERE (SELECT count(*) FROM customer) > 0")
def _(t):
    return names.pii_report(t.spark, _people(t).columns).select("field", "kind", "special")


@query("pv2_pii_segments", "SELECT * FROM (VALUES ('address__zip', 'address'), ('user__email', 'email')) v(field, kind) WHERE (SELECT count(*) FROM customer) > 0")
def _(t):
    rows = t.customer.select(F.col("c_name").alias("user__email"), F.col("c_name").alias("address__zip"), F.col("c_name").alias("user_email"))
    return names.pii_report(t.spark, rows.columns, segments=True).select("field", "kind")


@query("pv3_value_rates", f"""
SELECT 'text' AS "column", 'EMAIL' AS entity, count(*) FILTER (regexp_matches(text, '{_EMAIL}')) AS hits, round(count(*) FILTER (regexp_matches(text, '{_EMAIL}')) / count(*), 6) AS rate FROM documents
UNION ALL SELECT 'text', 'SSN', count(*) FILTER (regexp_matches(text, '\\b[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\\b')), round(count(*) FILTER (regexp_matches(text, '\\b[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\\b')) / count(*), 6) FROM documents""")
def _(t):
    return privacy.value_rates(t.documents, ["text"], ["EMAIL", "SSN"])


@query("pv3_card_check", "SELECT c_custkey AS id, c_custkey % 2 = 0 AS card FROM customer")
def _(t):
    return _people(t).select("id", privacy.has_value(F.col("note"), "CARD").alias("card"))


_PAPERS = "(SELECT CASE o_orderkey % 7 WHEN 0 THEN 'pass C12345678.' WHEN 1 THEN 'lic D1234567' WHEN 2 THEN 'call 5551234567' WHEN 3 THEN 'or (555) 123-4567 and E123456789' WHEN 4 THEN 'AB1234567' WHEN 5 THEN 'C12345678 D123456789012' ELSE 'DE44500105175407324931 at 10.0.0.1' END AS note FROM orders)"


@query("pv3_papers", f"""
WITH p AS {_PAPERS}, m AS (
 SELECT unnest(['PASSPORT', 'LICENCE', 'PHONE', 'IBAN', 'IPV4']) AS entity,
  unnest([regexp_matches(note, '\\b[A-Z]\\d{{8}}\\b'), regexp_matches(regexp_replace(note, '\\b[A-Z]\\d{{8}}\\b', ' ', 'g'), '\\b[A-Z]\\d{{7,12}}\\b'),
   regexp_matches(note, '\\b(?:\\+?1[-.\\s]?)?\\(?\\d{{3}}\\)?[-.\\s]?\\d{{3}}[-.\\s]?\\d{{4}}\\b'), regexp_matches(note, '\\b[A-Z]{{2}}\\d{{2}}[A-Z0-9]{{11,30}}\\b'),
   regexp_matches(note, '\\b(?:(?:25[0-5]|2[0-4]\\d|[01]?\\d\\d?)\\.){{3}}(?:25[0-5]|2[0-4]\\d|[01]?\\d\\d?)\\b')]) AS hit FROM p)
SELECT 'note' AS "column", entity, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 6) AS rate FROM m GROUP BY entity""")
def _(t):
    notes = t.orders.select(F.expr(_PAPERS[len("(SELECT ") : _PAPERS.index(" AS note")]).alias("note"))
    return privacy.value_rates(notes, ["note"], ["PASSPORT", "LICENCE", "PHONE", "IBAN", "IPV4"])


@query("pv3_scan_values", "SELECT * FROM (VALUES ('comment', 'PHONE'), ('comment', 'SSN'), ('email', 'EMAIL'), ('note', 'CARD')) v(\"column\", entity) WHERE (SELECT count(*) FROM customer) > 0")
def _(t):
    return privacy.scan_values(_people(t), ["comment", "email", "note"]).select("column", "entity")


@query("pv4_classify", "SELECT * FROM (VALUES ('comment', 'PHONE'), ('email', 'EMAIL'), ('note', 'CARD')) v(\"column\", entity) WHERE (SELECT count(*) FROM customer) > 0")
def _(t):
    return privacy.classify_values(_people(t), ["comment", "email", "note"]).select("column", "entity")


@query("pv5_discover", "SELECT * FROM (VALUES ('full_name', 'name', 'name'), ('email', 'email', 'name'), ('age', 'age', 'name'), ('zip', 'postcode', 'name'), ('birth_date', 'birth', 'name'), ('comment', 'PHONE', 'value'), ('comment', 'SSN', 'value')) v(\"column\", finding, source) WHERE (SELECT count(*) FROM customer) > 0")
def _(t):
    return privacy.discover(_people(t), ["comment"]).select("column", "finding", "source")


_MASK = "'MASKED_' || substr(sha256({c}), 1, 12)"


@query("pv6_strategy", f"SELECT c_custkey AS id, {_MASK.format(c='c_name')} AS full_name, CASE WHEN c_custkey % 10 <> 0 THEN {_MASK.format(c='email')} END AS email, CAST(c_custkey % 100 AS BIGINT) AS age FROM (SELECT *, 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email FROM customer)")
def _(t):
    return privacy.apply_strategy(_people(t).select("id", "full_name", "email", "age", "zip"), "mask", {"zip": "drop", "age": "retain"})


@query("pv7_short_mask", "SELECT c_custkey, substr(sha256(c_name), 1, 8) AS c_name, substr(sha256(c_mktsegment), 1, 8) AS c_mktsegment FROM customer")
def _(t):
    return privacy.short_mask(t.customer, ["c_name", "c_mktsegment", "absent"]).select("c_custkey", "c_name", "c_mktsegment")


@query("pv8_classification", "SELECT c_custkey AS id, 'CONFIDENTIAL' AS _data_classification FROM customer")
def _(t):
    return privacy.tag_sensitivity(_people(t)).select("id", "_data_classification")


@query("pv9_encrypt_round_trip", "SELECT c_custkey AS id, true AS hidden, c_name AS full_name FROM customer")
def _(t):
    rows = privacy.encrypt(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name")), ["full_name"], _KEY)
    rows = rows.withColumn("hidden", F.col("full_name").startswith(privacy.ENCRYPTED))
    return privacy.decrypt(rows, ["full_name"], _KEY).select("id", "hidden", "full_name")


@query("pv10_noise_in_range", "SELECT count(*) AS rows, true AS inside FROM customer")
def _(t):
    ends = t.customer.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    noisy = privacy.add_noise(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"], epsilon=1.0, sensitivity=10.0)
    return noisy.crossJoin(F.broadcast(ends)).agg(F.count("*").alias("rows"), F.min(F.col("c_acctbal").between(F.col("lo"), F.col("hi"))).alias("inside"))


@query("pv10_noise_spread", "SELECT m AS mechanism, count(*) AS rows, true AS fresh, true AS centred, true AS spread FROM orders, (VALUES ('laplace'), ('gaussian')) v(m) GROUP BY m")
def _(t):
    """rows; whether two calls differ on nearly all rows; whether mean and mean size of the noise are those of its law within six standard errors."""
    out = None
    rows = t.orders.select("o_orderkey", "o_totalprice")
    for how, size in (("laplace", 20.0), ("gaussian", 20.0 * (2 * math.log(1.25e5)) ** 0.5)):
        once, again = (t.keep(privacy.add_noise(rows, ["o_totalprice"], 0.5, 10.0, how, clip=False).withColumnRenamed("o_totalprice", n)) for n in ("a", "b"))
        both = rows.join(once, "o_orderkey").join(again, "o_orderkey").withColumn("x", F.col("a") - F.col("o_totalprice"))
        n, mean = F.count("*"), F.lit(size * (1.0 if how == "laplace" else (2 / math.pi) ** 0.5))
        width = F.lit(size * (2**0.5 if how == "laplace" else 1.0)) / F.sqrt(n) * 6
        one = both.agg(n.alias("rows"), (F.avg((F.col("a") != F.col("b")).cast("int")) > 0.95).alias("fresh"), (F.abs(F.avg("x")) < width + size / 500).alias("centred"), (F.abs(F.avg(F.abs("x")) - mean) < width + size / 500).alias("spread"))
        one = one.select(F.lit(how).alias("mechanism"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("ag9_noisy_aggregates", "SELECT o_orderstatus, true AS near, true AS noisy, 1.0 AS spent, true AS refused FROM orders GROUP BY 1")
def _(t):
    """Group means with noise of scale 100: near the true ones (30 scales), none the same; spending is recorded, more than the cap refused."""
    budget = privacy.PrivacyBudget(t.spark, t.folder())
    how = dict(epsilon=1.0, sensitivity=100.0, budget=budget, dataset="orders", cap=1.5)
    noisy = t.keep(privacy.noisy_aggregates(t.orders, ["o_orderstatus"], {"o_totalprice": "mean"}, **how))
    refused = False
    try:
        privacy.noisy_aggregates(t.orders, ["o_orderstatus"], {"o_totalprice": "mean"}, **how)
    except ValueError:
        refused = True
    true = t.orders.groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("m"))
    off = F.abs(F.col("o_totalprice") - F.col("m"))
    return noisy.join(true, "o_orderstatus").select("o_orderstatus", (off < 3000).alias("near"), (off > 0).alias("noisy"), F.lit(budget.spent("orders")).alias("spent"), F.lit(refused).alias("refused"))


def _vault(t):
    empty = t.spark.createDataFrame([], "context string, value_hash string, pseudonym string, encrypted string")
    return t.keep(privacy.extend_vault(t.customer, {"c_name": "person"}, empty, _KEY))


@query("pv11_vault", "SELECT c_custkey, c_name AS back, true AS hidden FROM customer")
def _(t):
    vault = _vault(t)
    rows = privacy.pseudonymise(t.customer.select("c_custkey", "c_name"), {"c_name": "person"}, vault).withColumn("hidden", F.col("c_name").startswith("PSN_"))
    return privacy.reverse_pseudonyms(rows, "c_name", vault, _KEY).select("c_custkey", F.col("c_name").alias("back"), "hidden")


@query("pv11_vault_rotation", "SELECT 'person' AS context, count(DISTINCT c_name) AS pseudonyms FROM customer")
def _(t):
    return privacy.vault_counts(privacy.rotate_vault(_vault(t), _KEY, b"fedcba9876543210").filter("encrypted is not null"))


_CHART = """
SELECT CAST(c_custkey AS VARCHAR) AS PAT_ID, CAST(c_custkey AS VARCHAR) AS PAT_ENC_CSN_ID, CAST(c_custkey AS VARCHAR) AS PROV_NPI, c_name AS PAT_NAME, c_name AS PAT_ADDR, c_name AS CITY, c_name AS COUNTY,
 c_name AS PAT_EMAIL, c_name AS HOME_PHONE, c_name AS FAX_NO, c_name AS SSN, c_name AS POLICY_NUM, c_name AS VIN, c_name AS DEVICE_ID, c_name AS WEBSITE, c_name AS IP_ADDR, c_name AS PHOTO, c_name AS IRIS_SCAN,
 CASE WHEN c_custkey % 11 > 0 THEN CAST(c_custkey % 100 AS VARCHAR) END AS AGE,
 CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN 'x1' ELSE concat('Z-', lpad(CAST(c_custkey * 37 % 1000 AS VARCHAR), 3, '0'), '01') END AS ZIP,
 concat(CAST(1950 + c_custkey % 70 AS VARCHAR), '-03-04') AS ORDERING_DATE, CASE WHEN c_custkey % 3 > 0 THEN concat(CAST(1900 + c_custkey % 100 AS VARCHAR), '/1/2') ELSE '3.4.1990' END AS BIRTH_DATE, c_mktsegment AS DIAGNOSIS
FROM customer"""


@query("pv12_safe_harbour", f"""
SELECT substr(sha256(PAT_ID), 1, 16) AS PAT_ID, substr(sha256(PAT_ENC_CSN_ID), 1, 16) AS PAT_ENC_CSN_ID, substr(sha256(PROV_NPI), 1, 16) AS PROV_NPI, CASE WHEN CAST(AGE AS INTEGER) >= 90 THEN '90+' ELSE AGE END AS AGE,
 CASE WHEN ZIP IS NULL THEN '' WHEN z IN ('1', '036','059','063','102','203','556','692','790','821','823','830','831','878','879','884','890','893') THEN '000' ELSE z END AS ZIP,
 substr(ORDERING_DATE, 1, 4) AS ORDERING_DATE, regexp_extract(BIRTH_DATE, '^[0-9]{{4}}') AS BIRTH_DATE, DIAGNOSIS FROM (SELECT *, substr(regexp_replace(ZIP, '[^0-9]', '', 'g'), 1, 3) AS z FROM ({_CHART}))""")
def _(t):
    return privacy.safe_harbour(t.spark.sql(_CHART.replace("VARCHAR", "STRING").replace("FROM customer", "FROM {customer}"), customer=t.customer))


_TRANSFERS = "SELECT s_suppkey, CASE s_suppkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN ' fr ' WHEN 2 THEN 'jp' WHEN 3 THEN 'IN' WHEN 4 THEN 'de' WHEN 5 THEN 'BR' END AS d, CASE s_suppkey % 4 WHEN 0 THEN 'standard_contractual_clauses' WHEN 1 THEN 'Binding_Corporate_Rules' WHEN 2 THEN 'handshake' END AS g FROM supplier"


@query("pv13_transfers", f"""SELECT s_suppkey, CASE WHEN upper(d) = 'DE' THEN 'DOMESTIC' WHEN trim(d) = 'fr' THEN 'INTRA_EU' WHEN d = 'jp' THEN 'ADEQUACY' WHEN d IS NULL THEN 'UNKNOWN'
 WHEN g IS NULL OR g LIKE 'standard%' THEN 'SCC' WHEN g LIKE 'Binding%' THEN 'BCR' ELSE 'UNKNOWN' END AS class FROM ({_TRANSFERS})""")
def _(t):
    rows = t.supplier.selectExpr("s_suppkey", "case s_suppkey % 7 when 0 then 'DE' when 1 then ' fr ' when 2 then 'jp' when 3 then 'IN' when 4 then 'de' when 5 then 'BR' end as d", "case s_suppkey % 4 when 0 then 'standard_contractual_clauses' when 1 then 'Binding_Corporate_Rules' when 2 then 'handshake' end as g")
    return rows.select("s_suppkey", privacy.transfer_class(F.lit("De "), F.col("d"), F.col("g")).alias("class"))


@query("pv14_regions", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' END AS country FROM supplier")
def _(t):
    target = F.expr("case s_suppkey % 3 when 0 then 's3.us-east-1.store' when 1 then 'db.EU-CENTRAL-1.host' else 'local' end")
    return t.supplier.select("s_suppkey", privacy.region_country(target).alias("country"))


@query("pv15_consent_log", "SELECT CAST(c_custkey AS VARCHAR) AS subject_hash, v AS version, CASE WHEN v = 1 AND c_custkey % 2 = 0 THEN '2024-02-01' WHEN c_custkey % 3 = 0 THEN '2024-03-01' END AS withdrawn_utc FROM customer, (VALUES (1), (2)) x(v) WHERE v = 1 OR c_custkey % 2 = 0")
def _(t):
    s = F.col("c_custkey").cast("string").alias("subject_hash")
    none = F.lit(None).cast("string")
    one = t.customer.select(s, F.lit("ads").alias("purpose"), F.lit("grant").alias("action"), F.lit("2024-01-01").alias("at"), none.alias("expires_utc"))
    two = t.customer.filter("c_custkey % 2 = 0").select(s, F.lit("ads").alias("purpose"), F.lit("grant").alias("action"), F.lit("2024-02-01").alias("at"), none.alias("expires_utc"))
    end = t.customer.filter("c_custkey % 3 = 0").select(s, none.alias("purpose"), F.lit("withdraw").alias("action"), F.lit("2024-03-01").alias("at"), none.alias("expires_utc"))
    return privacy.consent_events(one.unionByName(two).unionByName(end)).select("subject_hash", "version", "withdrawn_utc")


@query("pv16_breach_signals", """
WITH l AS (SELECT user_id, count(*) AS n, min(user_id) AS k FROM events GROUP BY user_id),
x AS (SELECT CAST(user_id AS VARCHAR) AS dataset, n, k,
 [CASE WHEN k % 2 = 0 THEN 'COLUMNS_VANISHED' END, CASE WHEN k % 3 > 0 AND k % 5 = 0 THEN 'FIRST_PII_LOAD' END, CASE WHEN n > 5 THEN 'BULK_LOAD' END,
  CASE WHEN k % 4 = 1 THEN 'QUALITY_COLLAPSE' END, CASE WHEN 100 * (k % 7) > 500 THEN 'BULK_ERASURE' END, CASE WHEN k % 11 <> 3 AND k % 13 > 0 THEN 'NEW_COUNTRY' END] AS s FROM l)
SELECT dataset, signal, CASE WHEN signal IN ('COLUMNS_VANISHED', 'QUALITY_COLLAPSE', 'BULK_ERASURE') THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
 CASE WHEN signal IN ('COLUMNS_VANISHED', 'QUALITY_COLLAPSE', 'BULK_ERASURE') THEN 72 END AS deadline_hours
FROM (SELECT dataset, unnest(list_filter(s, lambda v: v IS NOT NULL)) AS signal FROM x)""")
def _(t):
    """A load a user: columns lost by every second one, first personal fields, sizes, scores at and under the floor, erasures, transfers."""
    loads = t.events.groupBy("user_id").agg(F.count("*").alias("rows")).selectExpr(
        "cast(user_id as string) as dataset",
        "user_id as k",
        "rows",
        "case when user_id % 3 > 0 then array('email') else cast(array() as array<string>) end as pii_fields",
        "case when user_id % 2 = 0 then array('a') else array('a', 'b', 'new') end as columns",
        "case user_id % 4 when 0 then 40.0D when 1 then 39.9D when 2 then null else 90.0D end as quality",
        "case when user_id % 13 = 0 then null when user_id % 11 = 3 then 'DE' else 'IN' end as country",
        "100 * (user_id % 7) as erased",
    )
    known = loads.selectExpr("dataset", "array('a', 'b') as columns", "case when k % 5 = 0 then cast(array() as array<string>) else array('phone') end as pii_fields", "array('DE') as countries")
    return privacy.breach_signals(loads, known, bulk=5, erasures=500)


@query("govern_distinct_masks", "SELECT DISTINCT 'MASKED_' || substr(sha256(c_name), 1, 12) AS name FROM customer")
def _(t):
    return aggregates.distinct_rows(t.customer.select(mask(F.col("c_name")).alias("name")))
