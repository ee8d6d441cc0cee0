"""Value expressions: coercion, normalising, masking, checks. All are built-in column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that stand for true and false.
TRUE, FALSE = ("true", "1", "yes", "y"), ("false", "0", "no", "n")

# Country names and ISO 3166 codes.
COUNTRIES = {
    "united states": "US", "united states of america": "US", "usa": "US", "united kingdom": "GB", "great britain": "GB", "england": "GB",
    "germany": "DE", "france": "FR", "spain": "ES", "italy": "IT", "netherlands": "NL", "belgium": "BE", "switzerland": "CH", "austria": "AT",
    "sweden": "SE", "norway": "NO", "denmark": "DK", "finland": "FI", "ireland": "IE", "portugal": "PT", "poland": "PL", "canada": "CA",
    "mexico": "MX", "brazil": "BR", "argentina": "AR", "australia": "AU", "new zealand": "NZ", "japan": "JP", "china": "CN", "india": "IN",
    "south korea": "KR", "singapore": "SG", "south africa": "ZA",
}

# Calling code and digits of a national number by region.
PHONES = {"US": ("1", 10, 10), "CA": ("1", 10, 10), "GB": ("44", 9, 10), "DE": ("49", 6, 11), "FR": ("33", 9, 9), "ES": ("34", 9, 9), "IT": ("39", 6, 11), "NL": ("31", 9, 9), "CH": ("41", 9, 9), "AU": ("61", 9, 9), "IN": ("91", 10, 10)}

#: Formats that dates are tried in, one after the other.
DATES = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "MMM d, yyyy")


def present(c: Column) -> Column:
    """Not null and not blank."""
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def to_boolean(c: Column, true: Sequence[str] = TRUE, false: Sequence[str] = FALSE) -> Column:
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin(*true), F.lit(True)).when(text.isin(*false), F.lit(False))


def to_timestamp(c: Column, formats: Sequence[str] = DATES) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c.cast("string"), F.lit(f)) for f in formats])


def coerce(c: Column, kind: str) -> Column:
    """One of the six families; a value that does not fit becomes null, except that text null becomes the empty text."""
    match kind.lower():
        case "int" | "integer" | "bigint" | "long":
            return c.try_cast("bigint")
        case "float" | "double" | "numeric" | "decimal":
            return c.try_cast("double")
        case "str" | "string" | "text" | "object":
            return F.coalesce(c.cast("string"), F.lit(""))
        case "bool" | "boolean":
            return to_boolean(c)
        case "datetime" | "timestamp":
            return to_timestamp(c)
        case "date":
            return F.date_format(to_timestamp(c), "yyyy-MM-dd")
    raise ValueError(f"unknown type: {kind}")


def iso_date(c: Column, formats: Sequence[str] = DATES) -> Column:
    """yyyy-MM-dd; what is no date stays as it is."""
    return F.coalesce(F.date_format(to_timestamp(c, formats), "yyyy-MM-dd"), c.cast("string"))


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def country_code(c: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(COUNTRIES), F.lower(F.trim(c))), c)


def bool_text(c: Column) -> Column:
    """True or False for the words that say so, others as they are."""
    b = to_boolean(c)
    return F.when(b, F.lit("True")).when(~b, F.lit("False")).otherwise(c)


def phone_e164(c: Column, region: str = "US") -> Column:
    """+, calling code, national digits; what does not have the region's number of digits stays as it is."""
    code, least, most = PHONES[region]
    digits = F.regexp_replace(c, "[^0-9]", "")
    national = F.when(F.trim(c).startswith("+") & digits.startswith(code), F.substring(digits, len(code) + 1, 20)).otherwise(F.regexp_replace(digits, "^0+", ""))
    national = F.when(F.trim(c).startswith("+") & ~digits.startswith(code), F.lit("")).otherwise(national)
    if region in ("US", "CA"):
        national = F.when((F.length(national) == 11) & national.startswith("1"), F.substring(national, 2, 10)).otherwise(national)
    return F.when(F.length(national).between(least, most), F.concat(F.lit(f"+{code}"), national)).otherwise(c)


def text_rule(c: Column, rule: str) -> Column:
    """upper, lower, strip, title (a capital after every character that is no letter), date_iso8601, country_iso2, bool_normalize, phone_e164."""
    rules = {"upper": F.upper, "lower": F.lower, "strip": F.trim, "title": title, "date_iso8601": iso_date, "country_iso2": country_code, "bool_normalize": bool_text, "phone_e164": phone_e164}
    return rules[rule](c)


def title(c: Column) -> Column:
    letters = F.regexp_extract_all(c, F.lit(r"[\p{L}]+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(letters, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))), "")


def mask(c: Column, digits: int = 12, prefix: str = "MASKED_") -> Column:
    """prefix and the first hex digits of SHA-256 of the value as text; null stays null."""
    return F.when(c.isNotNull(), F.concat(F.lit(prefix), F.substring(F.sha2(c.cast("string"), 256), 1, digits)))


def map_values(c: Column, values: dict) -> Column:
    """Mapped values; others stay."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c) if pairs else c


def flag(c: Column, op: str, threshold: float) -> Column:
    """Numeric comparison as a boolean; what is no number is false, but true for neq."""
    x, t = c.cast("string").try_cast("double"), F.lit(float(threshold))
    tests = {"gt": x > t, "gte": x >= t, "lt": x < t, "lte": x <= t, "eq": x == t, "neq": x != t}
    return F.coalesce(tests[op], F.lit(op == "neq"))


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the check sum."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.when(x * 2 > 9, x * 2 - 9).otherwise(x * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def changed(a: Column, b: Column) -> Column:
    """Rows whose value changed; null to null is no change."""
    return F.count_if(~a.eqNullSafe(b))


def is_text(df, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)
