"""Scalar column functions, all built-in Spark expressions.

Every function maps Column -> Column without lambdas, so whole-stage codegen
stays on and no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Whitespace removed by TRIM (the reference engine trims whitespace, not only
# spaces): space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = " \t\n\x0b\f\r"
# Gender code map: M <- M, MALE, H ; F <- F, FEMALE, MUJER ; anything else U.
GENDER_MALE = ["M", "MALE", "H"]
GENDER_FEMALE = ["F", "FEMALE", "MUJER"]
# Marital code map: S <- S, SINGLE, SOLTERO, SOLTERA ; M <- M, MARRIED, CASADO, CASADA ; else U.
MARITAL_SINGLE = ["S", "SINGLE", "SOLTERO", "SOLTERA"]
MARITAL_MARRIED = ["M", "MARRIED", "CASADO", "CASADA"]
# MakeFlag text counted as TRUE after UPPER(TRIM(.)).
MAKEFLAG_TRUE = ["1", "TRUE", "Y"]
# Month file name pattern of the orders landing files.
ORDERS_FILE_MONTH = r"orders_(\d{4}-\d{2})\.csv$"
# Date-format cascade of the ingest month filter, after the declared pattern.
CASCADE_FORMATS = ["%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%m/%d/%Y", "%m-%d-%Y"]
# Declared manifest patterns and the strptime format each one selects.
DECLARED_PATTERNS = {"M/d/yyyy": "%m/%d/%Y", "MM/dd/yyyy": "%m/%d/%Y",
                     "MM-dd-yyyy": "%m-%d-%Y", "M-d-yyyy": "%m-%d-%Y"}
# ---------------------------------------------------------------------------

_WS_CLASS = "[ \\t\\n\\x0B\\f\\r]"
INT_TEXT = f"^{_WS_CLASS}*[+-]?[0-9]+{_WS_CLASS}*\\z"
NUM_TEXT = f"^{_WS_CLASS}*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?{_WS_CLASS}*\\z"
DEC_TEXT = f"^{_WS_CLASS}*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+){_WS_CLASS}*\\z"
MDY_TEXT = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z"   # \z: not before a final line break


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F4 trim -------------------------------------------------------------------
def trim_ws(c) -> Column:
    """TRIM of leading/trailing whitespace (spaces, tabs, line breaks)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


# F1 safe casts ---------------------------------------------------------------
def safe_int(c) -> Column:
    """TRY(CAST(x AS INT)): optional sign and digits only, overflow -> NULL."""
    c = _c(c)
    return F.when(c.rlike(INT_TEXT), trim_ws(c).try_cast("int"))


def safe_double(c) -> Column:
    """TRY(CAST(x AS DOUBLE)) restricted to plain decimal / exponent text.

    Spark alone would also accept '1d' or 'NaN'; the guard keeps one meaning.
    """
    c = _c(c)
    return F.when(c.rlike(NUM_TEXT), trim_ws(c).try_cast("double"))


def safe_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """TRY(CAST(x AS DECIMAL(p,s))): rounds half up, overflow -> NULL."""
    c = _c(c)
    return F.when(c.rlike(DEC_TEXT), trim_ws(c).try_cast(f"decimal({precision},{scale})"))


def strict_int(c) -> Column:
    """CAST(x AS INT) that fails the job on bad text (ANSI cast)."""
    return trim_ws(c).cast("int")


# F3 date parse ---------------------------------------------------------------
def parse_mdy(c) -> Column:
    """TRY(date_parse(x, '%m/%d/%Y')) as DATE: 1-2 digit month/day, 4-digit year."""
    c = _c(c)
    return F.when(c.rlike(MDY_TEXT), F.regexp_replace(c, MDY_TEXT, "$3-$1-$2").try_cast("date"))


def parse_mdy_ts(c) -> Column:
    """Same parse, typed as a time-zone-free TIMESTAMP (the engine's date_parse type)."""
    return parse_mdy(c).cast("timestamp_ntz")


# F7 date-text cascade ------------------------------------------------------------
_MONTH, _DAY, _YEAR = "(1[0-2]|0[1-9]|[1-9])", "(3[01]|[12][0-9]|0[1-9]|[1-9])", "([0-9]{4})"
# One alternative per family of formats, its year, month and day in groups of
# its own; families exclude one another by shape, so only the two dash forms compete.
_YEAR_FIRST = f"(?<y0>{_YEAR})([-/])(?<m0>{_MONTH})\\3(?<d0>{_DAY})"      # %Y-%m-%d, %Y/%m/%d
_SLASHES = f"(?<m1>{_MONTH})/(?<d1>{_DAY})/(?<y1>{_YEAR})"               # %m/%d/%Y
_DAY_FIRST = f"(?<d2>{_DAY})-(?<m2>{_MONTH})-(?<y2>{_YEAR})"             # %d-%m-%Y
_MONTH_FIRST = f"(?<m3>{_MONTH})-(?<d3>{_DAY})-(?<y3>{_YEAR})"           # %m-%d-%Y


def date_head(c) -> Column:
    """strip, then cut at the first 'T', then at the first space."""
    return F.substring_index(F.substring_index(trim_ws(c), "T", 1), " ", 1)


def parse_cascade(c, declared: str | None = "MM-dd-yyyy") -> Column:
    """First format of the cascade that parses decides the date (F7): the
    declared one, then CASCADE_FORMATS in order.

    One replacement rewrites a text that fits as year-month-day behind a mark
    (groups that took no part are empty); what has no mark has no date.  Every
    step uses its input once, so the expression stays small inside generated
    code.  (A text that fits the first dash form but is no date never fits the
    second one: one of its two numbers is above 12.)
    """
    dashes = [_MONTH_FIRST, _DAY_FIRST] if DECLARED_PATTERNS.get(declared or "") == "%m-%d-%Y" \
        else [_DAY_FIRST, _MONTH_FIRST]
    fits = f"^(?:{'|'.join([_YEAR_FIRST, _SLASHES, *dashes])})\\z"
    part = {c: "".join(f"${{{c}{k}}}" for k in range(4)) for c in "ymd"}
    marked = F.regexp_replace(F.translate(date_head(c), "\u0001", " "), fits,
                              f"\u0001{part['y']}-{part['m']}-{part['d']}")
    return F.split_part(marked, F.lit("\u0001"), F.lit(2)).try_cast("date")


def check_run_month(ym: str) -> str:
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", ym or ""):
        raise ValueError(f"run_month must be YYYY-MM, got {ym!r}")
    return ym


def in_run_month(c, run_month: str, declared: str | None = "MM-dd-yyyy") -> Column:
    """TRUE when the text date falls in run_month; unparsable -> FALSE."""
    check_run_month(run_month)
    # every format writes the year in four digits: most rows need no parsing
    return F.coalesce(_c(c).contains(run_month[:4])
                      & (F.date_format(parse_cascade(c, declared), "yyyy-MM") == F.lit(run_month)), F.lit(False))


def parsed_month(c, declared: str | None = "MM-dd-yyyy") -> Column:
    """'yyyy-MM' of the cascade-parsed date, NULL when no format parses."""
    return F.date_format(parse_cascade(c, declared), "yyyy-MM")


# F6 / F12 -------------------------------------------------------------------
def blank_to_null(c) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def flag_true(c) -> Column:
    """CASE UPPER(TRIM(x)) WHEN '1'/'TRUE'/'Y' THEN TRUE ELSE FALSE (NULL -> FALSE)."""
    return F.coalesce(F.upper(trim_ws(c)).isin(MAKEFLAG_TRUE), F.lit(False))


# F10 / F11 code maps ------------------------------------------------------------
def gender_code(c) -> Column:
    c = _c(c)
    return F.when(c.isin(GENDER_MALE), "M").when(c.isin(GENDER_FEMALE), "F").otherwise("U")


def marital_code(c) -> Column:
    c = _c(c)
    return F.when(c.isin(MARITAL_SINGLE), "S").when(c.isin(MARITAL_MARRIED), "M").otherwise("U")


# F8 money normaliser -------------------------------------------------------------
def clean_money(c) -> Column:
    """Normalise money text to plain decimal text.

    Keep digits, ',' and '.'; with both separators the last one is the
    decimal point; commas alone are decimal commas; dots alone are thousands
    separators when every later group has 3 digits.  The minus sign is lost.
    """
    t = trim_ws(c)
    s = F.regexp_replace(t, "[^0-9,.]", "")
    has_c = F.instr(s, ",") > 0
    has_d = F.instr(s, ".") > 0
    int_part = F.regexp_replace(F.regexp_extract(s, "^(.*)[,.]", 1), "[^0-9]", "")
    dec_raw = F.regexp_extract(s, "[,.]([0-9]*)$", 1)
    dec_part = F.when(dec_raw == "", F.lit("0")).otherwise(dec_raw)
    return (
        F.when(t.isNull() | (t == ""), F.lit(None).cast("string"))
        .when(has_c & has_d, F.concat(int_part, F.lit("."), dec_part))
        .when(has_c, F.regexp_replace(s, ",", "."))
        .when(has_d, F.when(s.rlike(r"^[0-9]*(\.[0-9]{3})+$"), F.regexp_replace(s, "[.]", ""))
              .otherwise(s))
        .when(s == "", F.lit(None).cast("string"))
        .otherwise(s)
    )


# F14-F17, F20, F21 month helpers -----------------------------------------------
def month_start(ym) -> Column:
    return F.to_date(F.concat(_c(ym), F.lit("-01")))


def next_month(ym) -> Column:
    return F.date_format(F.add_months(month_start(ym), 1), "yyyy-MM")


def month_year(ym) -> Column:
    return F.split(_c(ym), "-").getItem(0).cast("int")


def month_number(ym) -> Column:
    return F.split(_c(ym), "-").getItem(1).cast("int")


def month_padded(ym) -> Column:
    return F.lpad(F.split(_c(ym), "-").getItem(1).cast("int").cast("string"), 2, "0")


# F19 ---------------------------------------------------------------------------
def month_from_key(c) -> Column:
    m = F.regexp_extract(_c(c), ORDERS_FILE_MONTH, 1)
    return F.when(m != "", m)


# I2 key classifier (F23 predicates) ---------------------------------------------
def classify_key(bucket, key, expected_bucket: str, prefix: str = "bronze/source",
                 table_marker: str = "table=orders/") -> Column:
    b, k = _c(bucket), _c(key)
    return (
        F.when(b != F.lit(expected_bucket), "IGNORED_OTHER_BUCKET")
        .when(~k.startswith(prefix), "IGNORED_PREFIX")
        .when(~k.contains(table_marker), "IGNORED_NOT_ORDERS")
        .when(~k.endswith(".csv"), "IGNORED_NOT_CSV")
        .when(month_from_key(k).isNull(), "IGNORED_BAD_NAME")
        .otherwise("ACCEPTED")
    )


# F22 -------------------------------------------------------------------------
def safe_ratio(num, den) -> Column:
    return F.try_divide(_c(num), _c(den))


# F24 -------------------------------------------------------------------------
def decode_key(c) -> Column:
    """Percent-decode an object key ('+' -> space); a malformed escape stays as
    it is."""
    return F.try_url_decode(F.regexp_replace(_c(c), "%(?![0-9A-Fa-f]{2})", "%25"))


# F25 -------------------------------------------------------------------------
def now_utc() -> Column:
    """Current timestamp (session time zone UTC by default in this package)."""
    return F.current_timestamp()


def epoch_seconds() -> Column:
    return F.unix_timestamp()
