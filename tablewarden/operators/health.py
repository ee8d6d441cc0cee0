"""Clinical tables to the common data model, and clinical extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import concept_ids

# Concept ids of source codes.
GENDER = {"1": 8532, "2": 8507, "F": 8532, "M": 8507}
RACE = {"1": 8527, "2": 8516, "3": 8515, "4": 8557, "5": 8657}
ETHNICITY = {"1": 38003564, "2": 38003563}
VISIT = {"101": 9201, "102": 9202, "103": 9203, "I": 9201, "O": 9202, "E": 9203}
INPATIENT = 9201
PRIMARY, SECONDARY, EHR = 32902, 32908, 32817


def _code(c: str, table: dict[str, int], default: int = 0) -> Column:
    pairs = [F.lit(x) for p in table.items() for x in p]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(c).cast("string")), F.lit(default))


def _date(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string").try_cast("date"), F.col(c).cast("string").try_cast("timestamp").cast("date"))


def person(df: DataFrame) -> DataFrame:
    born = _date("BIRTH_DATE")
    part = lambda f: F.coalesce(f(born), F.lit(0))
    return df.select(
        F.col("PAT_ID").alias("person_source_value"),
        _code("SEX_C", GENDER).alias("gender_concept_id"),
        part(F.year).alias("year_of_birth"),
        part(F.month).alias("month_of_birth"),
        part(F.dayofmonth).alias("day_of_birth"),
        _code("PATIENT_RACE_C", RACE).alias("race_concept_id"),
        _code("ETHNIC_GROUP_C", ETHNICITY).alias("ethnicity_concept_id"),
    )


def visit_occurrence(df: DataFrame) -> DataFrame:
    """Start and end fall back to CONTACT_DATE where the table has no such column, not where it is null."""
    at = lambda c: _date(c) if c in df.columns else _date("CONTACT_DATE")
    return df.select(
        F.col("PAT_ENC_CSN_ID").alias("visit_source_value"),
        F.col("PAT_ID").alias("person_source_value"),
        _code("ADT_PAT_CLASS_C", VISIT, INPATIENT).alias("visit_concept_id"),
        at("HOSP_ADMSN_TIME").alias("visit_start_date"),
        at("HOSP_DISCH_TIME").alias("visit_end_date"),
        F.lit(EHR).alias("visit_type_concept_id"),
        F.col("VISIT_PROV_ID").alias("provider_source_value"),
    )


def numbered(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """A stable id: the hash of the keys, so that no global order is needed."""
    return df.withColumn(name, F.xxhash64(*keys))


def _blank(c: str) -> Column:
    return F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))


def condition_occurrence(df: DataFrame, concepts: DataFrame) -> DataFrame:
    """ICD-10, else ICD-9."""
    ten, nine = _blank("CURRENT_ICD10_LIST"), _blank("CURRENT_ICD9_LIST")
    rows = df.withColumns({"_code": F.coalesce(ten, nine), "_vocabulary": F.when(ten.isNotNull(), "ICD10CM").otherwise("ICD9CM")})
    rows = numbered(concept_ids(rows, "_code", F.col("_vocabulary"), concepts, "condition_concept_id"), "condition_occurrence_id", ["PAT_ENC_CSN_ID", "PAT_ID", "LINE", "_code"])
    return rows.select("condition_occurrence_id", F.col("PAT_ID").alias("person_source_value"), "condition_concept_id", _date("CONTACT_DATE").alias("condition_start_date"), F.when(F.upper("PRIMARY_DX_YN") == "Y", PRIMARY).otherwise(SECONDARY).alias("condition_type_concept_id"), F.col("_code").alias("condition_source_value"), F.col("PAT_ENC_CSN_ID").alias("visit_source_value"))


def drug_exposure(df: DataFrame, concepts: DataFrame) -> DataFrame:
    rows = concept_ids(df, "MEDICATION_ID", "RxNorm", concepts, "drug_concept_id")
    return rows.select(F.col("ORDER_MED_ID").alias("drug_exposure_source_value"), F.col("PAT_ID").alias("person_source_value"), "drug_concept_id", _date("ORDERING_DATE").alias("drug_exposure_start_date"), F.col("QUANTITY").cast("string").try_cast("double").alias("quantity"), F.col("SIG").alias("sig"), F.col("MEDICATION_ID").alias("drug_source_value"), F.col("PAT_ENC_CSN_ID").alias("visit_source_value"))


def measurement(df: DataFrame, concepts: DataFrame) -> DataFrame:
    rows = concept_ids(df, "COMPONENT_ID", "LOINC", concepts, "measurement_concept_id")
    number = lambda c: F.col(c).cast("string").try_cast("double")
    return rows.select(F.col("RESULT_ID").alias("measurement_source_id"), F.col("PAT_ID").alias("person_source_value"), "measurement_concept_id", _date("RESULT_DATE").alias("measurement_date"), number("ORD_VALUE").alias("value_as_number"), number("REFERENCE_LOW").alias("range_low"), number("REFERENCE_HIGH").alias("range_high"), F.col("ORD_VALUE").cast("string").alias("value_source_value"), F.col("COMPONENT_ID").alias("measurement_source_value"))


def procedure_occurrence(df: DataFrame, concepts: DataFrame) -> DataFrame:
    rows = concept_ids(df, "PROC_CODE", "CPT4", concepts, "procedure_concept_id")
    return rows.select(F.col("ORDER_PROC_ID").alias("procedure_source_id"), F.col("PAT_ID").alias("person_source_value"), "procedure_concept_id", _date("ORDERING_DATE").alias("procedure_date"), F.lit(EHR).alias("procedure_type_concept_id"), F.col("PROC_CODE").alias("procedure_source_value"), F.col("PAT_ENC_CSN_ID").alias("visit_source_value"))


def extract(df: DataFrame, date: str, start: str, end: str, key: str | None = None, ids: DataFrame | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of a date range, of the listed ids if there is a list (a table, joined)."""
    rows = df.filter(F.col(date).between(start, end))
    if ids is not None:
        rows = rows.join(ids.select(F.col(ids.columns[0]).alias("_id")).distinct(), F.col(key) == F.col("_id"), "left_semi")
    return rows.select(*columns) if columns else rows


