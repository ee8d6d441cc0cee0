"""Personal data: finding it in values, masking, encryption, noise, pseudonyms, safe-harbour rules, transfers, breach signals."""

from __future__ import annotations

import math
import secrets
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import pii_columns
from ..functions.values import luhn, mask
from .commits import CommitLog

# Patterns of personal data in values.
VALUE_PATTERNS = {
    "EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "PHONE": r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "CARD": r"\b(?:\d{4}[-\s]?){3}\d{4}\b",
    "IPV4": r"\b(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\b",
    "PASSPORT": r"\b[A-Z]\d{8}\b",
    "LICENCE": r"\b[A-Z]\d{7,12}\b",
    "IBAN": r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b",
}


def has_value(c: Column, kind: str) -> Column:
    """Whether a text holds such a value. Cards must pass the check sum; a licence must stand outside passports."""
    pattern = VALUE_PATTERNS[kind]
    if kind == "CARD":
        return F.exists(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda x: luhn(F.regexp_replace(x, "[^0-9]", "")))
    if kind == "LICENCE":
        return F.regexp_replace(c, VALUE_PATTERNS["PASSPORT"], " ").rlike(pattern)
    return c.rlike(pattern)


def value_rates(df: DataFrame, columns: Sequence[str], kinds: Sequence[str] = tuple(VALUE_PATTERNS)) -> DataFrame:
    """column, entity, hits, rate over texts that are not null: all in one pass."""
    parts = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("entity"), F.count_if(has_value(F.col(c), k)).alias("hits"), F.count(c).alias("texts")) for c in columns for k in kinds]
    rows = df.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return rows.select("column", "entity", "hits", F.round(F.coalesce(F.col("hits") / F.when(F.col("texts") > 0, F.col("texts")), F.lit(0.0)), 6).alias("rate"))


def scan_values(df: DataFrame, columns: Sequence[str], confidence: float = 0.5) -> DataFrame:
    """The entities whose rate reaches a tenth of the confidence."""
    return value_rates(df, columns).filter((F.col("hits") > 0) & (F.col("rate") >= confidence / 10))


def classify_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, entity: the one of the highest rate (ties by name), among those found."""
    found = value_rates(df, columns).filter("hits > 0")
    return found.groupBy("column").agg(F.min_by("entity", F.struct(-F.col("rate"), F.col("entity"))).alias("entity"), F.max("rate").alias("rate"))


def discover(df: DataFrame, columns: Sequence[str], confidence: float = 0.5) -> DataFrame:
    """column, finding, source (name or value), rate."""
    spark = df.sparkSession
    names = spark.createDataFrame([(r["field"], r["kind"], "name", 1.0) for r in pii_columns(df.columns)], "column string, finding string, source string, rate double")
    return names.unionByName(scan_values(df, columns, confidence).select("column", F.col("entity").alias("finding"), F.lit("value").alias("source"), "rate"))


def apply_strategy(df: DataFrame, strategy: str = "mask", overrides: dict[str, str] | None = None) -> DataFrame:
    """mask, drop or retain the columns that look personal by name; overrides set it by column."""
    for r in pii_columns(df.columns):
        c, how = r["field"], (overrides or {}).get(r["field"], strategy)
        if how == "drop":
            df = df.drop(c)
        elif how == "mask":
            df = df.withColumn(c, mask(F.col(c)))
    return df


def short_mask(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: mask(F.col(c), 8, "") for c in columns if c in df.columns})


# Words in column names that make a table internal.
INTERNAL = ("internal", "employee", "salary", "cost", "margin", "price", "budget")


def sensitivity(columns: Sequence[str]) -> str:
    """RESTRICTED with special categories, CONFIDENTIAL with other personal data, INTERNAL by keyword, else PUBLIC."""
    found = pii_columns(columns)
    if any(r["special"] for r in found):
        return "RESTRICTED"
    if found:
        return "CONFIDENTIAL"
    return "INTERNAL" if any(w in c.lower() for c in columns for w in INTERNAL) else "PUBLIC"


def tag_sensitivity(df: DataFrame) -> DataFrame:
    return df.withColumn("_data_classification", F.lit(sensitivity(df.columns)))


ENCRYPTED = "ENCRYPTED:"


def encrypt(df: DataFrame, columns: Sequence[str], key: bytes) -> DataFrame:
    """AES-GCM of the value as text, in base 64 behind a prefix; nulls and what is encrypted already stay."""
    k = F.lit(key)
    enc = lambda c: F.concat(F.lit(ENCRYPTED), F.base64(F.aes_encrypt(c.cast("string").cast("binary"), k)))
    return df.withColumns({c: F.when(F.col(c).cast("string").startswith(ENCRYPTED), F.col(c).cast("string")).otherwise(enc(F.col(c))) for c in columns if c in df.columns})


def decrypt(df: DataFrame, columns: Sequence[str], key: bytes) -> DataFrame:
    """What can't be decrypted stays as it is."""
    k = F.lit(key)
    dec = lambda c: F.try_aes_decrypt(F.unbase64(F.substring(c, F.lit(len(ENCRYPTED) + 1), F.length(c))), k).cast("string")
    return df.withColumns({c: F.when(F.col(c).startswith(ENCRYPTED), F.coalesce(dec(F.col(c)), F.col(c))).otherwise(F.col(c)) for c in columns if c in df.columns})


class PrivacyBudget:
    """What has been spent on each dataset, in a commit log, so that two callers cannot both spend what is left."""

    def __init__(self, spark: SparkSession, root: str):
        self.log = CommitLog(spark, root, "dataset string, epsilon double, note string")

    def spent(self, dataset: str) -> float:
        return self._spent(self.log.entries(), dataset)

    @staticmethod
    def _spent(entries: DataFrame, dataset: str) -> float:
        return entries.filter(F.col("dataset") == dataset).agg(F.coalesce(F.sum("epsilon"), F.lit(0.0)).alias("e")).first()["e"]

    def spend(self, dataset: str, epsilon: float, cap: float, note: str = "") -> float:
        """What is spent now; an error, and nothing spent, beyond the cap."""
        total = 0.0

        def entry(entries: DataFrame) -> dict:
            nonlocal total
            used = self._spent(entries, dataset)
            if used + epsilon > cap + 1e-12:
                raise ValueError(f"privacy budget of {dataset} is spent: {used} of {cap}")
            total = used + epsilon
            return {"dataset": dataset, "epsilon": float(epsilon), "note": note}

        self.log.append(entry)
        return total


def _uniform(key: str, *parts: Column) -> Column:
    """In (0, 1], 52 bits of the SHA-256 of a key and the parts: the same if a task runs again, unknown without the key."""
    return (F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)


def add_noise(df: DataFrame, columns: Sequence[str], epsilon: float, sensitivity: float = 1.0, mechanism: str = "laplace", delta: float = 1e-5, clip: bool = True, seed: int | None = None, budget: PrivacyBudget | None = None, dataset: str = "", cap: float = math.inf) -> DataFrame:
    """Laplace (scale s/epsilon) or Gaussian noise, clipped to the range that the column had, if it had one. Nulls stay.

    Values and noise are multiples of a power of two that is a thousandth of the scale and of the sensitivity or less, so that the
    step added to the sensitivity widens the noise by a thousandth at most, and the noise is the difference of two geometric
    numbers (Laplace), so no digit of a value shows in the result. The randomness is a fresh 256-bit key for each
    call; a seed makes it repeat, for tests only. With a budget the spending is committed before anything is returned.
    """
    if epsilon <= 0 or sensitivity <= 0:
        raise ValueError("epsilon and sensitivity must be positive")
    if mechanism not in ("laplace", "gaussian"):
        raise ValueError(f"unknown mechanism: {mechanism}")
    if budget is not None:
        budget.spend(dataset, epsilon, cap, f"{mechanism}: {', '.join(columns)}")
    key = secrets.token_hex(32) if seed is None else f"seed {seed}"
    ends = df.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in columns], *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns]).first() if clip else None
    scale = sensitivity / epsilon if mechanism == "laplace" else sensitivity * math.sqrt(2 * math.log(1.25 / delta)) / epsilon
    grid = 2.0 ** math.floor(math.log2(min(scale, sensitivity) / 1024))
    row = F.monotonically_increasing_id().cast("string")
    out = {}
    for c in columns:
        u, v = (_uniform(key, F.lit(c), F.lit(part), row) for part in "ab")
        if mechanism == "laplace":
            # rounding to the grid may move a value's neighbour by one step more
            rate = grid * epsilon / (sensitivity + grid)
            steps = F.floor(F.log(u) / -rate) - F.floor(F.log(v) / -rate)
        else:
            steps = F.round(F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v) * ((sensitivity + grid) / sensitivity * scale / grid))
        x = (F.round(F.col(c).cast("double") / grid) + steps) * grid
        if clip and ends[f"lo_{c}"] is not None and ends[f"lo_{c}"] < ends[f"hi_{c}"]:
            x = F.greatest(F.least(x, F.lit(ends[f"hi_{c}"])), F.lit(ends[f"lo_{c}"]))
        out[c] = F.when(F.col(c).isNotNull(), x)
    return df.withColumns(out)


def spend_budget(spent: DataFrame, dataset: str, epsilon: float, cap: float) -> DataFrame:
    """The budget table (dataset, epsilon) with one more spending, or an error beyond the cap."""
    used = spent.filter(F.col("dataset") == dataset).agg(F.coalesce(F.sum("epsilon"), F.lit(0.0)).alias("e")).first()["e"]
    if used + epsilon > cap + 1e-12:
        raise ValueError(f"privacy budget of {dataset} is spent: {used} of {cap}")
    return spent.unionByName(spent.sparkSession.createDataFrame([(dataset, float(epsilon))], "dataset string, epsilon double"))


def noisy_aggregates(df: DataFrame, by: Sequence[str], aggs: dict[str, str], epsilon: float, sensitivity: float = 1.0, seed: int | None = None, budget: PrivacyBudget | None = None, dataset: str = "", cap: float = math.inf) -> DataFrame:
    """Aggregates of groups with noise; not clipped. See add_noise."""
    from .aggregates import aggregate

    return add_noise(aggregate(df, by, aggs), list(aggs), epsilon, sensitivity, clip=False, seed=seed, budget=budget, dataset=dataset, cap=cap)


# --- pseudonyms ------------------------------------------------------------------------------------------


def extend_vault(df: DataFrame, columns: dict[str, str], vault: DataFrame, key: bytes) -> DataFrame:
    """Rows (context, value_hash, pseudonym, encrypted) to append to the vault for values that it lacks. columns: column -> context.

    Pseudonyms are random: write the rows before they are used.
    """
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(x).alias("context"), F.col(c).cast("string").alias("value")) for c, x in columns.items()])).alias("x")).select("x.*").filter("value is not null").distinct()
    new = stacked.withColumn("value_hash", F.sha2("value", 256)).join(vault.select("context", "value_hash"), ["context", "value_hash"], "left_anti")
    return new.select("context", "value_hash", F.concat(F.lit("PSN_"), F.substring(F.sha2(F.uuid(), 256), 1, 16)).alias("pseudonym"), F.base64(F.aes_encrypt(F.col("value").cast("binary"), F.lit(key))).alias("encrypted"))


def pseudonymise(df: DataFrame, columns: dict[str, str], vault: DataFrame) -> DataFrame:
    """Each value's pseudonym in its context; null stays null."""
    for c, context in columns.items():
        known = vault.filter(F.col("context") == context).select(F.col("value_hash").alias("_hash"), F.col("pseudonym").alias("_pseudonym"))
        df = df.join(known, F.sha2(F.col(c).cast("string"), 256) == F.col("_hash"), "left").withColumn(c, F.col("_pseudonym")).drop("_hash", "_pseudonym")
    return df


def reverse_pseudonyms(df: DataFrame, column: str, vault: DataFrame, key: bytes) -> DataFrame:
    known = vault.select(F.col("pseudonym").alias("_p"), F.try_aes_decrypt(F.unbase64("encrypted"), F.lit(key)).cast("string").alias("_v"))
    return df.join(known, F.col(column) == F.col("_p"), "left").withColumn(column, F.coalesce("_v", column)).drop("_p", "_v")


def rotate_vault(vault: DataFrame, old: bytes, new: bytes) -> DataFrame:
    return vault.withColumn("encrypted", F.base64(F.aes_encrypt(F.try_aes_decrypt(F.unbase64("encrypted"), F.lit(old)), F.lit(new))))


def vault_counts(vault: DataFrame) -> DataFrame:
    return vault.groupBy("context").agg(F.count("*").alias("pseudonyms"))


# --- safe harbour ----------------------------------------------------------------------------------------

# Category, what is done to its columns, pattern of their names (case does not count, the first that is found holds).
SAFE_HARBOUR = [
    ("name", "drop", r"pat_name|patient_name|first_name|last_name|full_name|provider_name|prov_name|staff_name|contact_name|guarantor_name|\bname\b"),
    ("address", "drop", r"pat_addr|address|addr_line|street|mailing_address|home_address|res_addr"),
    ("zip", "zip", r"zip|postal|post_code|zipcode|zip_code|pat_zip"),
    ("city", "drop", r"city|town|borough|municipality|pat_city"),
    ("county", "drop", r"county|parish|district|precinct"),
    (
        "date",
        "year",
        r"admit_date|admission_date|discharge_date|service_date|procedure_date|surgery_date|contact_date|hosp_disch_time|inp_adm_date|death_date|dod\b|ordering_date|result_date|svc_date\b|eff_date\b|create_date|update_date|appt_date|visit_date|entry_date|referral_date|auth_date|expire_date|issue_date|start_date|end_date",
    ),
    ("birth_date", "year", r"birth_date|dob\b|date_of_birth|pat_brth_dt|birthdate"),
    ("age", "age", r"age_in_days|age_in_months|age_in_years|\bage\b|\bage_c\b|patient_age|cur_age|calc_age"),
    ("phone", "drop", r"phone|telephone|home_phone|work_phone|cell_phone|mobile|pat_home_phone|pat_work_phone|contact_phone"),
    ("fax", "drop", r"fax|fax_number|fax_num|fax_no"),
    ("email", "drop", r"email|e_mail|pat_email|email_address|electronic_mail"),
    ("ssn", "drop", r"ssn|social_security|soc_sec_num|social_security_num"),
    ("mrn", "hash", r"mrn\b|pat_mrn|pat_mrn_id|medical_record|med_rec_num|medical_record_number"),
    ("account_number", "hash", r"pat_id\b|patient_id\b|pat_enc_csn|csn\b|encounter_id|enc_id\b|visit_id\b|contact_serial_num"),
    ("health_plan", "drop", r"health_plan|plan_id|member_id|subscriber_id|insurance_id|policy_num|coverage_id|ben_plan_id|ben_id\b"),
    ("certificate_license", "hash", r"certificate|license_num|dea_num|dea_number|npi\b|prov_npi|provider_npi|state_license"),
    ("vehicle", "drop", r"vin\b|vehicle_id|license_plate|plate_num|vehicle_serial"),
    ("device", "drop", r"device_id|serial_num|serial_number|implant_id|device_serial|udi\b"),
    ("web_url", "drop", r"url\b|web_address|website|homepage|web_url|hyperlink"),
    ("ip_address", "drop", r"ip_address|ip_addr|\bip\b"),
    ("photo", "drop", r"photo|image|picture|profile_pic|facial_image"),
    ("biometric", "drop", r"fingerprint|voiceprint|retinal|biometric|iris_scan|palm_print"),
]
# ZIP areas of fewer than 20,000 people.
RESTRICTED_ZIP3 = ("036", "059", "063", "102", "203", "556", "692", "790", "821", "823", "830", "831", "878", "879", "884", "890", "893")


def safe_harbour_plan(columns: Sequence[str], overrides: dict[str, str] | None = None) -> dict[str, str]:
    """column -> drop, hash, zip, year or age, for the columns that identify by name. overrides: action by column."""
    import re

    found = {c: next((a for _, a, p in SAFE_HARBOUR if re.search(p, c, re.IGNORECASE)), None) for c in columns}
    found |= {c: a for c, a in (overrides or {}).items() if c in found}
    return {c: a for c, a in found.items() if a}


def safe_harbour(df: DataFrame, overrides: dict[str, str] | None = None, hash_identifiers: bool = True, age_cap: int = 90, label: str = "90+") -> DataFrame:
    """Drops identifiers, hashes record numbers (16 hex; or drops them, too), keeps three digits of ZIPs, years of dates, ages under the cap.

    A ZIP of fewer than three digits or of a restricted area is 000. Nulls and dates without a year in front become
    empty texts; a null age stays null, an age that is no number stays as it is.
    """
    plan = safe_harbour_plan(df.columns, overrides)
    out = {}
    for c, action in plan.items():
        x = F.col(f"`{c}`")
        text = x.cast("string")
        if action == "hash" and hash_identifiers:
            out[c] = F.coalesce(F.substring(F.sha2(text, 256), 1, 16), F.lit(""))
        elif action == "zip":
            digits = F.regexp_replace(text, "[^0-9]", "")
            three = F.substring(digits, 1, 3)
            out[c] = F.when(text.isNull(), "").when((F.length(digits) < 3) | three.isin(*RESTRICTED_ZIP3), "000").otherwise(three)
        elif action == "year":
            out[c] = F.coalesce(F.regexp_extract(text, "^([0-9]{4})", 1), F.lit(""))
        elif action == "age":
            out[c] = F.when(text.try_cast("double") >= age_cap, label).otherwise(text)
    return df.withColumns(out).drop(*[c for c, a in plan.items() if c not in out])


# --- transfers and breaches --------------------------------------------------------------------------------

# EU and EEA members, and countries with an adequacy decision.
EEA = ("AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK", "SI", "ES", "SE", "IS", "LI", "NO")
ADEQUATE = ("AD", "AR", "CA", "FO", "GG", "IL", "IM", "JP", "JE", "NZ", "KR", "CH", "GB", "UY", "US")
# Beginnings of cloud regions and the country they lie in.
REGIONS = {"us-": "US", "eu-west-1": "IE", "eu-west-2": "GB", "eu-west-3": "FR", "eu-central": "DE", "eu-north": "SE", "eu-south": "IT", "ap-northeast-1": "JP", "ap-northeast-2": "KR", "ap-southeast-1": "SG", "ap-southeast-2": "AU", "ap-south": "IN", "ca-central": "CA", "sa-east": "BR"}


# Names of safeguards.
SAFEGUARDS = {"SCC": "SCC", "STANDARD_CONTRACTUAL_CLAUSES": "SCC", "BCR": "BCR", "BINDING_CORPORATE_RULES": "BCR"}


def transfer_class(source: Column, destination: Column, safeguard: Column | None = None, default: str | None = "SCC") -> Column:
    """DOMESTIC, INTRA_EU, ADEQUACY, SCC or BCR (by safeguard), UNKNOWN. Countries whatever their case and the blanks around them.

    Without a safeguard column, and where it is null, `default` holds; a country that is not known makes a transfer UNKNOWN
    unless the destination has an adequacy decision.
    """
    a, b = F.upper(F.trim(source)), F.upper(F.trim(destination))
    s = F.upper(F.coalesce(safeguard if safeguard is not None else F.lit(None).cast("string"), F.lit(default).cast("string"), F.lit("")))
    named = F.lit(None).cast("string")
    for name, short in SAFEGUARDS.items():
        named = F.when(s == name, F.lit(short)).otherwise(named)
    return (
        F.when(a == b, "DOMESTIC")
        .when(a.isin(*EEA) & b.isin(*EEA), "INTRA_EU")
        .when(b.isin(*ADEQUATE), "ADEQUACY")
        .when(a.isNull() | b.isNull(), "UNKNOWN")
        .otherwise(F.coalesce(named, F.lit("UNKNOWN")))
    )


def region_country(target: Column) -> Column:
    """The country of a cloud region named in a destination, or null."""
    out = F.lit(None).cast("string")
    for region, country in reversed(REGIONS.items()):
        out = F.when(F.lower(target).contains(region), F.lit(country)).otherwise(out)
    return out


def consent_events(consents: DataFrame) -> DataFrame:
    """An append-only log (subject_hash, purpose, action: grant | withdraw, at, expires_utc) as records: a grant closes the one before, a withdrawal of a purpose (null: of all) closes the open one."""
    from pyspark.sql import Window

    w = Window.partitionBy("subject_hash", "purpose").orderBy("granted_utc")
    grants = consents.filter("action = 'grant'").select("subject_hash", "purpose", F.col("at").alias("granted_utc"), "expires_utc")
    grants = grants.withColumns({"version": F.row_number().over(w), "_until": F.lead("granted_utc").over(w)})
    ends = consents.filter("action = 'withdraw'").select(F.col("subject_hash").alias("_s"), F.col("purpose").alias("_p"), F.col("at").alias("_at"))
    hit = (F.col("subject_hash") == F.col("_s")) & (F.col("_p").isNull() | (F.col("_p") == F.col("purpose"))) & (F.col("_at") >= F.col("granted_utc")) & (F.col("_until").isNull() | (F.col("_at") < F.col("_until")))
    closed = grants.join(ends, hit, "left").groupBy(*grants.columns).agg(F.min("_at").alias("_w"))
    return closed.select("subject_hash", "purpose", "granted_utc", "expires_utc", F.least("_w", "_until").alias("withdrawn_utc"), "version")


def breach_signals(loads: DataFrame, known: DataFrame, bulk: int = 100_000, quality_floor: float = 40.0, erasures: int = 5_000) -> DataFrame:
    """dataset, signal, severity, deadline_hours for each load (dataset, rows, pii_fields, columns, quality, country, erased) against what is known of its dataset (dataset, columns, pii_fields) and of transfers (countries).

    COLUMNS_VANISHED (HIGH): a column of the last load is gone. FIRST_PII_LOAD (MEDIUM): personal fields in a dataset that
    had none. BULK_LOAD (MEDIUM): more than `bulk` rows, personal or not. QUALITY_COLLAPSE (HIGH): a score under the floor.
    BULK_ERASURE (HIGH): more than `erasures` rows erased. NEW_COUNTRY (MEDIUM): a transfer to a country that none went to before.
    HIGH has 72 hours. What is null gives no signal; a dataset that is not known has no columns that could be gone.
    """
    none = F.array().cast("array<string>")
    k = known.select(F.col("dataset"), F.col("columns").alias("_columns"), F.col("pii_fields").alias("_pii"), F.col("countries").alias("_countries"))
    rows = loads.join(k, "dataset", "left")
    tests = [
        ("COLUMNS_VANISHED", "HIGH", F.size(F.array_except(F.coalesce("_columns", none), F.coalesce("columns", none))) > 0),
        ("FIRST_PII_LOAD", "MEDIUM", (F.size(F.coalesce("pii_fields", none)) > 0) & (F.size(F.coalesce("_pii", none)) == 0)),
        ("BULK_LOAD", "MEDIUM", F.col("rows") > bulk),
        ("QUALITY_COLLAPSE", "HIGH", F.col("quality") < quality_floor),
        ("BULK_ERASURE", "HIGH", F.col("erased") > erasures),
        ("NEW_COUNTRY", "MEDIUM", F.col("country").isNotNull() & ~F.coalesce(F.array_contains("_countries", F.col("country")), F.lit(False))),
    ]
    found = F.filter(F.array(*[F.when(t, F.struct(F.lit(n).alias("signal"), F.lit(s).alias("severity"))) for n, s, t in tests]), lambda x: x.isNotNull())
    return rows.select("dataset", F.explode(found).alias("x")).select("dataset", "x.*", F.when(F.col("x.severity") == "HIGH", 72).alias("deadline_hours"))
