"""Text and number parsing as column expressions (JVM side; only NFKC needs a Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from brickrow import lookups
from brickrow.workers import nfkc_batch

# Unicode white space as one explicit class. Java's \s is ASCII only, and its Unicode variant
# leaves out U+001C..U+001F.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def collapse(c: Column) -> Column:
    """Runs of white space become one space; trimmed; empty becomes null."""
    return F.nullif(F.trim(F.regexp_replace(c, WS + "+", " ")), F.lit(""))


def strip(c: Column) -> Column:
    """White space cut off at both ends."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def whole_number(digits: Column) -> Column:
    return digits.try_cast("bigint")


def _digits_only(c: Column) -> Column:
    return whole_number(F.regexp_replace(c, "[^0-9]+", ""))


def first_int(c: Column) -> Column:
    """First run of digits: ``1 234`` gives 1."""
    return whole_number(F.regexp_extract(c, "([0-9]+)", 1))


def price_eur(c: Column) -> Column:
    """Digits, spaces and dots before a euro sign: ``1.250 000 €`` gives 1250000."""
    # The possessive run already takes the spaces before the sign and never backtracks.
    return _digits_only(F.regexp_extract(c, f"([0-9](?:[0-9.]|{WS})*+)€", 1))


def area_m2(c: Column) -> Column:
    """Digits directly before ``m²``: ``1 200 m²`` gives 200."""
    return whole_number(F.regexp_extract(c, f"([0-9]++){WS}*m²", 1))


def energy_kwh(c: Column) -> Column:
    """Digits directly before ``kWh/m²/year``."""
    return whole_number(F.regexp_extract(c, f"([0-9]++){WS}*kWh/m²/year", 1))


def cadastral_eur(c: Column) -> Column:
    """Amount that follows "cadastral income" or "cadastral revenue" in running text."""
    found = F.regexp_extract(
        c, f"(?i)cadastral{WS}+(?:income|revenue)[^0-9]{{0,40}}([0-9](?:[0-9.]|{WS})*+)€", 1
    )
    return _digits_only(found)


def yes_no_lenient(c: Column) -> Column:
    """``Yes`` / ``No`` by containment, so ``unknown`` is ``No``."""
    v = F.lower(c)
    yes = v.contains("yes") | v.rlike(f"^{WS}*(?:true|y){WS}*$")
    no = v.contains("no") | v.rlike(f"^{WS}*(?:false|n){WS}*$")
    return F.when(yes, "Yes").when(no, "No")


def locality_postal(c: Column) -> Column:
    return F.nullif(F.regexp_extract(collapse(c), "^([0-9]{4}) .", 1), F.lit(""))


def locality_name(c: Column) -> Column:
    """Name after a four-digit code; a code glued to the name is cut off as well."""
    s = collapse(c)
    cut = F.regexp_replace(s, "^[0-9]{4} *[-–]? *", "")
    return F.nullif(F.when(locality_postal(c).isNotNull(), F.substr(s, F.lit(6))).otherwise(cut), F.lit(""))


def looks_like_locality(c: Column) -> Column:
    return c.rlike(f"(?d)^{WS}*[0-9]{{4}}{WS}+[A-Za-z].+$")


def norm_label(c: Column) -> Column:
    """Lower case without punctuation other than ``- ( ) /``; ``²`` as ``2``; null as ''."""
    kept = F.regexp_replace(F.lower(collapse(c)), r"[^\p{L}\p{N}_ \-()²/]+", "")
    spaced = F.trim(F.regexp_replace(F.translate(kept, "²", "2"), " +", " "))
    return F.coalesce(spaced, F.lit(""))


# Marked so that the optimizer leaves one call per value instead of copying it into pushed filters.
nfkc_worker = F.arrow_udf(nfkc_batch, StringType()).asNondeterministic()


def nfkc(c: Column) -> Column:
    """Unicode NFKC. ASCII values are sent to the Python worker as nulls and kept as they are."""
    wide = F.when(F.octet_length(c) > F.char_length(c), c)
    return F.coalesce(nfkc_worker(wide), c)


def blank_tokens(c: Column) -> Column:
    """Collapse white space; the words that stand for "missing" become null."""
    spaced = F.trim(F.regexp_replace(c, WS + "+", " "))
    return F.when(~F.lower(spaced).isin(lookups.NULL_TOKENS), spaced)


def to_number(c: Column) -> Column:
    """Comma as decimal point, everything but digits, dots and minus dropped; bad is null."""
    return F.regexp_replace(F.translate(c, ",", "."), r"[^0-9.\-]+", "").try_cast("double")


def yes_no_strict(c: Column) -> Column:
    """Exact words only, of text that :func:`blank_tokens` has seen."""
    v = F.lower(c)
    return F.when(v.isin(lookups.YES_WORDS), "yes").when(v.isin(lookups.NO_WORDS), "no")


def postal_digits(c: Column) -> Column:
    """First four digits anywhere: ``B-1000`` gives 1000, ``12345`` gives 1234."""
    return F.nullif(F.regexp_extract(c, "([0-9]{4})", 1), F.lit(""))
