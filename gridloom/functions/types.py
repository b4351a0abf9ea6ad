"""Types of text values as column expressions: the load rules (7 types) and the proposal rules (5).

Every predicate is guarded by a pattern first, since ``try_cast`` alone takes more than the rules
do. Patterns use ASCII digits. Week dates and seven-digit compact dates are out of scope.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The load types in the order of inference, and their boolean words.
LOAD_TYPES = ("BOOLEAN", "BIGINT", "NUMERIC", "TIMESTAMP", "DATE", "TIME")
BOOLEAN_WORDS = {"true": True, "t": True, "yes": True, "y": True, "false": False, "f": False, "no": False, "n": False}

INT, INT_THOUSANDS = r"^[+-]?[0-9]+$", r"^[+-]?[0-9]{1,3}(,[0-9]{3})+$"
NUMBER = r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9]+)?$"
NUMBER_THOUSANDS = r"^[+-]?[0-9]{1,3}(,[0-9]{3})*(\.[0-9]+)?$"
#: Digits before and after the point, and the exponent, of a number without separators.
PARTS = r"^[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
#: What any number looks like, and numbers so short that the decimal type holds them whatever their digits.
NUMBER_LIKE, SHORT_NUMBER = r"^[+-]?[0-9.][0-9.,_]*([eE][+-]?[0-9]+)?$", r"^[+-]?[0-9]{1,20}(\.[0-9]{0,18})?$"
#: The decimal type of numbers.
PRECISION, SCALE = 38, 18
CLOCK = r"([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.,][0-9]{1,6})?)?"
#: The usual layouts of days and moments, which a cast takes as they are.
ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ISO_MOMENT = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} {CLOCK.replace('.,', '.')}$"
#: Date layouts: pattern, and the parts' places in year, month, day.
DATES = ((r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", (1, 2, 3)), (r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$", (1, 2, 3)), (r"^([0-9]{4})([0-9]{2})([0-9]{2})$", (1, 2, 3)), (r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})$", (3, 2, 1)))


def _day(text: Column, pattern: str, places: tuple[int, int, int]) -> Column:
    year, month, day = (F.regexp_extract(text, pattern, p) for p in places)
    iso = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(text.rlike(pattern) & (year != "0000"), iso.try_cast("date"))


def as_date(text: Column) -> Column:
    iso = F.when(~text.startswith("0000"), text.try_cast("date"))
    # by length and places of marks first, as most texts are no dates and each layout is a pattern
    marked = F.substring(text, 5, 1).isin("-", "/") | (F.length(text) == 8) | (F.substring(text, -5, 1) == ".")
    return F.when(F.length(text).between(8, 12) & marked, F.when(text.rlike(ISO_DAY), iso).otherwise(F.coalesce(*[_day(text, *layout) for layout in DATES])))


def as_boolean(text: Column) -> Column:
    low = F.lower(text)
    # by length first: no word is longer than the longest, in capitals neither
    return F.when(F.length(text) <= max(map(len, BOOLEAN_WORDS)), F.when(low.isin([w for w, v in BOOLEAN_WORDS.items() if v]), True).when(low.isin([w for w, v in BOOLEAN_WORDS.items() if not v]), False))


def as_bigint(text: Column) -> Column:
    return F.when(text.rlike(INT), text.try_cast("bigint")).when(text.contains(",") & text.rlike(INT_THOUSANDS), F.replace(text, F.lit(","), F.lit("")).try_cast("bigint"))


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, "[,_]", "")


def _exact(text: Column) -> Column:
    """Whether the digits of a number before and after its point fit the decimal type."""
    plain = _plain(text)
    part = lambda n: F.coalesce(F.regexp_extract(plain, PARTS, n), F.lit(""))
    digits = F.concat(part(1), part(2))
    trimmed = F.regexp_replace(digits, "0+$", "")
    exponent = F.when(part(3) == "", 0).otherwise(part(3).try_cast("int"))
    after = F.length(part(2)) - (F.length(digits) - F.length(trimmed)) - exponent
    before = F.length(F.regexp_replace(digits, "^0+", "")) - F.length(part(2)) + exponent
    return F.coalesce((trimmed == "") | (after <= SCALE) & (before <= PRECISION - SCALE), F.lit(False))


def is_numeric(text: Column) -> Column:
    """Whether the decimal type holds the number exactly: its digits before and after the point must fit.

    Special values (NaN, infinities) and longer numbers have no exact decimal; their columns are TEXT. Digits are
    counted for long and odd numbers only, in a function over an array: written out, the count makes the
    code of a whole stage longer than the JVM compiles (8000 bytes), and every row of it is interpreted.
    """
    odd = F.exists(F.array(text), lambda t: (t.rlike(NUMBER) | t.rlike(NUMBER_THOUSANDS)) & _exact(t))
    found = F.when(text.rlike(SHORT_NUMBER), True).when(text.rlike(NUMBER_LIKE), odd).otherwise(False)
    return F.when(text.isNotNull(), found)


def as_numeric(text: Column) -> Column:
    """An exact decimal, or null where the number has none."""
    return F.when(is_numeric(text), _plain(text).try_cast(f"decimal({PRECISION},{SCALE})"))


def numeric_text(text: Column, signed: bool = False) -> Column:
    """A number's own digits as a database prints them: its scale stays, signs and zeros in front go.

    Numbers with an exponent are written out, without zeros at the end. With ``signed`` a zero keeps its minus.
    """
    plain = F.regexp_replace(_plain(text), r"^\+", "")
    plain = F.regexp_replace(F.regexp_replace(plain, r"^(-?)0+(?=[0-9])", "$1"), r"^(-?)\.", "$10.")
    plain = F.regexp_replace(plain, r"\.$", "")
    plain = plain if signed else F.regexp_replace(plain, r"^-(?=[0.]+$)", "")
    written = F.regexp_replace(F.regexp_replace(as_numeric(text).cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(text.rlike("[eE]"), written).otherwise(plain)


def as_time(text: Column) -> Column:
    """TIME of day from HH:MM, HH:MM:SS (to microseconds) or HHMMSS; with an offset it stays text."""
    compact = r"^([01][0-9]|2[0-3])([0-5][0-9])([0-5][0-9])$"
    loose = r"^([0-9]{1,2}):([0-9]{1,2})(:([0-9]{1,2}))?$"
    part = lambda n: F.lpad(F.regexp_extract(text, loose, n), 2, "0")
    padded = F.concat(part(1), F.lit(":"), part(2), F.lit(":"), part(4))
    whole = F.when(F.length(text) == 5, F.concat(text, F.lit(":00"))).otherwise(F.replace(text, F.lit(","), F.lit(".")))
    made = F.when(text.rlike(f"^{CLOCK}$"), whole).when(text.rlike(compact), F.regexp_replace(text, compact, "$1:$2:$3")).when(text.rlike(loose), padded)
    return F.when((F.length(text) <= 17) & (text.contains(":") | (F.length(text) == 6)), made.try_cast("time(6)"))


def time_text(text: Column) -> Column:
    """HH:mm:ss, with the fraction of a second where there is one."""
    return as_time(text).cast("string")


def as_timestamp(text: Column) -> Column:
    """TIMESTAMP without zone; a value with an offset stays text."""
    pattern = rf"^([0-9]{{4}})-?([0-9]{{2}})-?([0-9]{{2}})[ Tt]({CLOCK})$"
    slashed = r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2}) ([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})$"
    dashed = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})[ T]([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})$"
    cast = lambda t: t.try_cast("timestamp_ntz")
    iso = F.replace(F.regexp_replace(text, pattern, "$1-$2-$3 $4"), F.lit(","), F.lit("."))
    pads = lambda p: F.concat(F.regexp_extract(text, p, 1), *[x for n in (2, 3) for x in (F.lit("-"), F.lpad(F.regexp_extract(text, p, n), 2, "0"))], F.lit(" "), F.regexp_extract(text, p, 4))
    other = F.coalesce(F.when(text.rlike(pattern), cast(iso)), F.when(text.rlike(dashed), cast(pads(dashed))), F.when(text.rlike(slashed), cast(pads(slashed))))
    return F.when(text.contains(":") & (F.length(text) >= 13), F.when(text.rlike(ISO_MOMENT), cast(text)).otherwise(other))


#: Value of a stripped text by load type; null where the text does not conform.
READERS = {"BOOLEAN": as_boolean, "BIGINT": as_bigint, "NUMERIC": as_numeric, "TIMESTAMP": as_timestamp, "DATE": as_date, "TIME": as_time}


def conforms(text: Column, kind: str) -> Column:
    """Whether a stripped non-blank text reads as a load type; null for null."""
    return is_numeric(text) if kind == "NUMERIC" else F.when(text.isNotNull(), READERS[kind](text).isNotNull())


def text_form(text: Column, kind: str, signed: bool = False) -> Column:
    """What a value reads as after its column was widened: the typed value's text, else the raw text."""
    if kind == "TEXT":
        return text
    if kind == "NUMERIC":
        return F.when(is_numeric(text), numeric_text(text, signed)).otherwise(text)
    return F.coalesce(READERS[kind](text).cast("string"), text)


# Name tokens of the proposal rules.
IDENTIFIER_TOKENS = frozenset({"account", "client", "code", "customer", "document", "guid", "id", "identifier", "no", "number", "subnumber"})
DATE_TOKENS = frozenset({"created", "date", "dt", "due", "end", "modified", "start", "updated"})
INT64_MAX, INT64_MIN = str(2**63 - 1), str(2**63)
SIGNED, DECIMAL = r"^[+-]?[0-9]+$", r"^[+-]?[0-9]+\.[0-9]+$"


def whole_digits(text: Column) -> Column:
    return F.regexp_extract(text, r"^[+-]?([0-9]+)(\.[0-9]+)?$", 1)


def fraction_digits(text: Column) -> Column:
    return F.regexp_extract(text, r"^[+-]?[0-9]+\.([0-9]+)$", 1)


def leading_zero(text: Column) -> Column:
    return whole_digits(text).rlike("^0[0-9]")


def fits_int64(text: Column) -> Column:
    """By length and digits, as texts: numbers beyond any numeric type are compared too."""
    digits = F.regexp_replace(whole_digits(text), "^0+(?=.)", "")
    most = F.when(text.startswith("-"), INT64_MIN).otherwise(INT64_MAX)
    return (F.length(digits) < 19) | (F.length(digits) == 19) & (digits <= most)


def proposal_date(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{8}$"), as_date(text).isNotNull()).otherwise(False)
