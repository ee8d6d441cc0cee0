"""Column names: sanitising, personal data by name, identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Patterns that mark a column as personal data, with the kind they stand for.
PII_PATTERNS = {
    "name": r"\b(first|last|full|sur|given|family|middle|maiden)?_?name\b",
    "email": r"\be?_?mail(_address)?\b",
    "phone": r"\b(phone|mobile|cell|fax|telephone)(_number|_no)?\b",
    "national_id": r"\b(ssn|social_security(_number)?|national_id|nino|sin|tax_id|tin)\b",
    "passport": r"\bpassport(_number|_no)?\b",
    "driving_licence": r"\b(driver|driving)s?_licen[cs]e(_number|_no)?\b",
    "birth": r"\b(dob|date_of_birth|birth_?date|birthday)\b",
    "age": r"\bage\b",
    "address": r"\b(street|home|postal|mailing)?_?address\b|\bstreet\b",
    "postcode": r"\b(zip|zip_?code|post_?code|postal_code)\b",
    "geo": r"\b(lat|latitude|lon|lng|longitude|gps)\b",
    "ip": r"\bip(_address|v4|v6)?\b",
    "device": r"\b(mac_address|device_id|imei|cookie_id)\b",
    "bank": r"\b(iban|account_number|routing_number|sort_code|swift|bic)\b",
    "card": r"\b(credit_?card|card_number|cvv|pan)\b",
    "salary": r"\b(salary|income|wage)\b",
    "login": r"\b(user_?name|login|password)\b",
    "gender": r"\b(gender|sex)\b",
    "race": r"\b(race|ethnicity|ethnic_group)\b",
    "religion": r"\b(religion|religious_belief)\b",
    "politics": r"\b(political_opinion|party_membership)\b",
    "health": r"\b(diagnosis|medical_record|mrn|health|disability|blood_type|icd10)\b",
    "orientation": r"\bsexual_orientation\b",
    "biometric": r"\b(biometric|fingerprint|face_id|retina)\b",
    "union": r"\bunion_membership\b",
    "crime": r"\b(criminal_record|conviction)\b",
}
# Kinds under special protection.
SPECIAL = {"race", "religion", "politics", "health", "orientation", "biometric", "union"}


def sanitise(name: str) -> str:
    """Lower case, all but a-z, 0-9 and _ to _, no _ at the ends."""
    return re.sub(r"[^a-z0-9_]", "_", name.strip().lower()).strip("_")


def sanitise_all(df: DataFrame) -> DataFrame:
    """Sanitised column names; names that fall together get _2, _3 and so on, in order; an empty name becomes col."""
    taken: set[str] = set()
    out = []
    for c in df.columns:
        base = new = sanitise(c) or "col"
        k = 1
        while new in taken:
            k += 1
            new = f"{base}_{k}"
        taken.add(new)
        out.append(new)
    return df.toDF(*out)


def pii_columns(names: Iterable[str], segments: bool = False) -> list[dict]:
    """Columns that look like personal data. `_` is a letter to the patterns, so user_email is none; with segments, the parts of user__email are looked at."""
    out = []
    for c in names:
        parts = c.lower().split("__") if segments else [c.lower()]
        kind = next((k for k, p in PII_PATTERNS.items() if any(re.search(p, x) for x in parts)), None)
        if kind:
            special = kind in SPECIAL
            out.append({"field": c, "kind": kind, "special": special, "gdpr": "Art. 9" if special else "Art. 4(1)", "ccpa": "1798.140(ae)" if special else "1798.140(v)"})
    return out


def pii_report(spark: SparkSession, names: Iterable[str], segments: bool = False) -> DataFrame:
    return spark.createDataFrame([tuple(r.values()) for r in pii_columns(names, segments)], "field string, kind string, special boolean, gdpr string, ccpa string")


def check_identifier(name: str) -> str:
    """A plain identifier of 128 characters at most, or an error."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]{0,127}", name or ""):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def check_columns(df: DataFrame) -> DataFrame:
    for c in df.columns:
        if not c.strip() or any(x in c for x in "\0;'\"`\n\r"):
            raise ValueError(f"unsafe column name: {c!r}")
    return df
