"""Text cleaning and the normal forms that identity rules compare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped or split into tokens.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Text that stands for a missing value.
NONE_TEXT = "None"
NAN_TEXT = "nan"
UNKNOWN = "unknown"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Trim every kind of white space (``trim`` removes blanks only)."""
    return F.btrim(_c(value), F.lit(WHITESPACE))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_c(value), F.lit(""))


def lower_trim(value: Column | str) -> Column:
    return F.lower(F.trim(_c(value)))


def domain_after_first_at(email: Column | str) -> Column:
    """Everything behind the first @; '' when there is none, null for null."""
    return F.regexp_extract(_c(email), "@(.+)$", 1)


def domain_part_two(email: Column | str) -> Column:
    """The piece between the first and the second @; '' when there is none, null for null."""
    return F.split_part(_c(email), F.lit("@"), F.lit(2))


def name_skip_nulls(first: Column | str, last: Column | str) -> Column:
    return F.concat_ws(" ", F.trim(_c(first)), F.trim(_c(last)))


def name_null_if_any_null(first: Column | str, last: Column | str) -> Column:
    return F.concat(F.trim(_c(first)), F.lit(" "), F.trim(_c(last)))


def name_stripped(first: Column | str, last: Column | str) -> Column:
    parts = [F.coalesce(strip(c), F.lit("")) for c in (first, last)]
    return strip(F.concat(parts[0], F.lit(" "), parts[1]))


def enum_null_unknown(value: Column | str) -> Column:
    """Null becomes 'unknown'; other values are lower-cased and trimmed."""
    return F.coalesce(lower_trim(value), F.lit(UNKNOWN))


def enum_sentinel_unknown(value: Column | str) -> Column:
    """Null and the text 'None' become 'unknown'; other values are lower-cased, not trimmed."""
    return F.lower(F.coalesce(F.nullif(_c(value), F.lit(NONE_TEXT)), F.lit(UNKNOWN)))


def enum_blank_unknown(value: Column | str) -> Column:
    """Null and '' become 'unknown'; other values are lower-cased and stripped."""
    return strip(F.lower(F.coalesce(blank_to_null(value), F.lit(UNKNOWN))))


def normal_email(email: Column | str) -> Column:
    """Lower-cased and stripped; '' for null, '' and 'None'."""
    usable = F.nullif(_c(email), F.lit(NONE_TEXT))
    return F.coalesce(strip(F.lower(usable)), F.lit(""))


def normal_name(name: Column | str) -> Column:
    """Lower-cased, stripped, without dots and commas; '' for null, '' and 'None'."""
    usable = F.nullif(_c(name), F.lit(NONE_TEXT))
    return F.coalesce(F.translate(strip(F.lower(usable)), ".,", ""), F.lit(""))


def normal_domain(email: Column | str) -> Column:
    return domain_part_two(normal_email(email))


def sorted_tokens(text: Column | str) -> Column:
    """Words in code point order, joined by one blank."""
    return F.array_join(F.sort_array(F.split(strip(text), WHITESPACE_CLASS + "+")), " ")


def global_id(email: Column | str, email_domain: Column | str) -> Column:
    """Stable person id from the normalized email and the email domain."""
    key = F.concat(normal_email(email), F.lit(":"), F.coalesce(_c(email_domain), F.lit("")))
    return F.concat(F.lit("gid_"), F.substring(F.md5(key), 1, 12))


def is_usable(value: Column | str) -> Column:
    """A text that is neither null, '' nor one of the missing-value texts."""
    return F.coalesce(~_c(value).isin("", NONE_TEXT, NAN_TEXT), F.lit(False))


def is_usable_number(value: Column | str) -> Column:
    """A number that is neither null, NaN nor zero (zero counts as missing)."""
    as_double = _c(value).cast("double")
    return F.coalesce((as_double != 0) & ~F.isnan(as_double), F.lit(False))
