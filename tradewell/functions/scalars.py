"""Scalar column expressions. All JVM-side: no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Form 4 transaction code -> label, as the screener prints it.
TRADE_CODE_LABELS = {
    "P": "Purchase",
    "S": "Sale",
    "A": "Grant",
    "D": "Sale to Iss",
    "G": "Gift",
    "F": "Tax",
    "M": "OptEx",
    "X": "OptEx",
    "C": "Cnv Deriv",
    "W": "Inherited",
}
UNKNOWN_LABEL = "Unknown"

# The characters Python's str.split() / str.strip() treat as space, by rule.
PY_WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value, body) -> Column:
    """``body(value)`` with the value computed once for each row. The body is
    not part of the generated code: what is rare or long belongs in one, as a
    generated method beyond 8,000 bytes is never compiled by the JVM. It is the
    last step of an empty fold: an item taken from an array would ask for its
    type, and so walk the whole body, for every row."""
    return F.aggregate(F.array().cast("array<int>"), _c(value), lambda v, _: v, body)


# R1 -------------------------------------------------------------------------
def round_half_away(x, precision: int = 0) -> Column:
    """Round the *scaled double* half away from zero.

    ``s = x * 10^p``; an exact .5 fraction moves away from zero, anything else
    goes to the nearest integer. Spark's ``round`` works on the decimal text of
    the double (1.005 -> 1.01) and would not match.
    """
    x = _c(x).cast("double")
    factor = float(10 ** precision)
    s = x * F.lit(factor)
    frac = s % F.lit(1.0)                 # sign of s, exact in IEEE
    whole = s - frac
    r = F.when(F.abs(frac) == F.lit(0.5), whole + F.signum(s)).otherwise(F.rint(s))
    if precision == 0:
        return r
    return r / F.lit(factor)


# R2 -------------------------------------------------------------------------
def _capitalize(p: Column) -> Column:
    return F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))


# Words of visible ASCII without a hyphen or ``Mc``, blanks between them only.
_USUAL_NAME = r"\A(?:(?![Mm][Cc])[!-,.-~]++(?: ++(?=[!-~])|\z))++\z"


def normalize_name(name) -> Column:
    """Whitespace split, capitalize each word (and each hyphen part), the
    ``Mc`` rule on the third letter, single-space join."""
    def usual(n):
        return F.initcap(F.when(n.contains("  "), F.regexp_replace(n, " +", " ")).otherwise(n))

    return let(name, lambda n: F.when(n.rlike(_USUAL_NAME), usual(n)).otherwise(_normalize_any(n)))


def _normalize_any(name) -> Column:
    # every Python whitespace char -> ' ', then a literal split (no regex)
    spaced = F.translate(_c(name), PY_WS_CHARS, " " * len(PY_WS_CHARS))
    words = F.filter(F.split(spaced, " "), lambda w: w != F.lit(""))

    def fix(w):
        cap = F.array_join(F.transform(F.split(w, "-", -1), _capitalize), "-")
        mc = (F.lower(cap).startswith("mc")) & (F.length(cap) > 2)
        return F.when(mc, F.concat(F.substring(cap, 1, 2),
                                   F.upper(F.substring(cap, 3, 1)),
                                   F.lower(F.substring(cap, 4, 1 << 30)))).otherwise(cap)

    return F.array_join(F.transform(words, fix), " ")


# R3 / R4 --------------------------------------------------------------------
def _flag_set(x) -> Column:
    return _c(x).isin("true", "1")


def owner_title(is_officer, officer_title, is_director, is_ten_pct, remarks) -> Column:
    """Officer title (or ``See Remarks`` -> remarks text), ``Director``,
    ``10% Owner`` joined by ``, ``; ``No Title`` when none applies.

    A NULL result means the reference would fail the filing: empty officer
    title element, or a ``See Remarks`` title with an empty remarks element.
    """
    officer_title, remarks = _c(officer_title), _c(remarks)
    text = F.coalesce(officer_title, F.lit("See Remarks"))
    # '' officer title: `None in ...` raises in the reference -> NULL (reject)
    text = F.when(officer_title == F.lit(""), F.lit(None).cast("string")).otherwise(text)
    text = F.when(text.contains("See Remarks") & remarks.isNotNull(),
                  F.when(remarks == F.lit(""), F.lit(None).cast("string")).otherwise(remarks)
                  ).otherwise(text)
    officer, director, ten = (F.coalesce(_flag_set(x), F.lit(False)) for x in (is_officer, is_director, is_ten_pct))
    return (F.when(officer & text.isNull(), F.lit(None).cast("string"))
             .when(~officer & ~director & ~ten, F.lit("No Title"))
             .otherwise(F.concat_ws(", ", F.when(officer, text), F.when(director, F.lit("Director")),
                                    F.when(ten, F.lit("10% Owner")))))


# R5 -------------------------------------------------------------------------
def trade_type(code) -> Column:
    """``<code> - <label>``; unknown codes get ``Unknown``."""
    code = _c(code)
    m = F.create_map(*[F.lit(v) for kv in TRADE_CODE_LABELS.items() for v in kv])
    return F.concat(code, F.lit(" - "), F.coalesce(F.try_element_at(m, code), F.lit(UNKNOWN_LABEL)))


# R6 -------------------------------------------------------------------------
def signed_qty(qty, a_d) -> Column:
    return F.when(_c(a_d) == F.lit("D"), -_c(qty)).otherwise(_c(qty))


# R8 -------------------------------------------------------------------------
def _ntz(y, mo, d, h, mi, sec) -> Column:
    """Wall-clock timestamp from parts, NULL if invalid. Built without any
    session time zone (a parse to TIMESTAMP then a cast would move wall
    times that fall in a DST gap of the session zone)."""
    return F.try_make_timestamp_ntz(y.cast("int"), mo.cast("int"), d.cast("int"),
                                    h.cast("int"), mi.cast("int"), sec.cast("decimal(16,6)"))


def acceptance_ts(text) -> Column:
    """``<ACCEPTANCE-DATETIME>yyyyMMddHHmmss`` -> timestamp_ntz."""
    digits = F.regexp_extract(_c(text), r"<ACCEPTANCE-DATETIME>([0-9]{14})(?![0-9])", 1)
    part = lambda d, a, n: F.substring(d, a, n)
    return let(digits, lambda d: F.when(d != F.lit(""), _ntz(
        part(d, 1, 4), part(d, 5, 2), part(d, 7, 2), part(d, 9, 2), part(d, 11, 2), part(d, 13, 2))))


# R9 -------------------------------------------------------------------------
def trade_date_text(text) -> Column:
    """Date of a Form 4 date text in any layout of ``coerce_ts``; its time and
    zone are dropped."""
    return coerce_date(text)


# R10 / F5 -------------------------------------------------------------------
def is_cik(text) -> Column:
    return _c(text).rlike(r"^[0-9]{1,10}$")


def pad_cik(text) -> Column:
    return F.lpad(_c(text).cast("string"), 10, "0")


# R11 ------------------------------------------------------------------------
def accession_key(acc) -> Column:
    return F.regexp_replace(_c(acc), "-", "")


def archive_path(cik, acc) -> Column:
    return F.concat_ws("/", F.lit("Archives/edgar/data"), _c(cik), accession_key(acc),
                       F.concat(_c(acc), F.lit(".txt")))


# R12-R14 --------------------------------------------------------------------
_INT_TEXT = r"^[+-]?[0-9]+$"


# Decimal digits with an optional exponent: not the JVM's 12.5d or 0x1p3.
_DECIMAL_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def decimal_text(t) -> Column:
    """A decimal number text as a double; NULL for anything else, also for what
    no finite double holds."""
    x = F.when(t.rlike(_DECIMAL_TEXT), t.try_cast("double"))
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def money_value(text) -> Column:
    """Value cell: drop ``+ $ ,``, keep the sign, number or NULL."""
    return decimal_text(let(F.regexp_replace(_c(text), r"[+$,]", ""), strip_ws))


def money_price(text) -> Column:
    """Price cell: drop ``$`` and thousands commas (the reference keeps commas
    and so loses prices >= 1,000; we strip them like the Value cell)."""
    return decimal_text(let(F.regexp_replace(_c(text), r"[$,]", ""), strip_ws))


def clean_qty(text) -> Column:
    """Qty cell: drop ``+ ,``; integral text only, else NULL."""
    t = let(F.regexp_replace(_c(text), r"[+,]", ""), strip_ws)
    return F.when(t.rlike(_INT_TEXT), t.try_cast("bigint"))


def int_or_zero(text) -> Column:
    """Filing share text: Python ``int()`` semantics, non-integral -> 0."""
    t = strip_ws(text)
    return F.coalesce(F.when(t.rlike(_INT_TEXT), t.try_cast("bigint")), F.lit(0).cast("bigint"))


def int_out_of_range(text) -> Column:
    """Whether an integral text is beyond what a signed share count can hold."""
    t = strip_ws(text)
    n = t.try_cast("bigint")
    return F.coalesce(t.rlike(_INT_TEXT) & (n.isNull() | (n == F.lit(-(1 << 63)))), F.lit(False))


def float_or_zero(text) -> Column:
    """Filing price text: a decimal number or a spelling of NaN or infinity, else 0."""
    t = strip_ws(text)
    known = t.rlike(_DECIMAL_TEXT) | t.rlike(r"^[+-]?(?i:nan|inf|infinity)$")
    return F.coalesce(F.when(known, t.try_cast("double")), F.lit(0.0))


# R15 ------------------------------------------------------------------------
def delimiter_safe(title, sep: str) -> Column:
    t = _c(title)
    if sep == ",":
        return F.replace(t, F.lit(","), F.lit(";"))
    if sep == ";":
        return F.replace(t, F.lit(";"), F.lit(","))
    return t


# R16 ------------------------------------------------------------------------
# The layout of most texts: yyyy-MM-dd, then optionally [ T]HH:mm, :ss and .fraction.
_TS_TEXT = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})(?:[ T]([0-9]{2}):([0-9]{2})(?::([0-9]{2})(\.[0-9]+)?)?)?$"
# Further layouts: ISO with short parts, yyyyMMdd, day and month in figures (/),
# month by name before or after the day; each with a time, AM or PM, and a zone.
_CLOCK = (r"(?:[ T]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}(?:\.[0-9]+)?))?(?: ?([AaPp])\.?[Mm]\.?)?)?"
          r"(?: ?(?:Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2}))?$")
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_MONTH_NAME = ("(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
               "|nov(?:ember)?|dec(?:ember)?)")
_LAYOUTS = {  # pattern of the date, then the groups of year, month and day
    "iso": (r"^([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})", (1, 2, 3)),
    "packed": (r"^([0-9]{4})([0-9]{2})([0-9]{2})", (1, 2, 3)),
    "month first": (r"^([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})", (3, 1, 2)),
    "day first": (r"^([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})", (3, 2, 1)),
    "named month first": (rf"^({_MONTH_NAME})\.? +([0-9]{{1,2}}),? +([0-9]{{4}})", (3, 1, 2)),
    "named month second": (rf"^([0-9]{{1,2}})[ -]({_MONTH_NAME})\.?,?[ -]([0-9]{{4}})", (3, 2, 1)),
}


def _by_layout(t, name: str) -> Column:
    pattern, groups = _LAYOUTS[name]
    whole = pattern + _CLOCK
    part = lambda g: F.regexp_extract(t, whole, g)
    year, month, day = (part(g) for g in groups)
    if name.startswith("named"):
        month = (F.position(F.initcap(F.substring(month, 1, 3)), F.lit(_MONTHS)) + 2) / 3
    hour = F.when(part(4) == "", "0").otherwise(part(4)).cast("int")
    noon = F.lower(part(7))
    hour = F.when(noon == "", hour).when(hour.between(1, 12), hour % 12 + F.when(noon == "p", 12).otherwise(0))
    zero = lambda x: F.when(x == "", "0").otherwise(x)
    return F.when(t.rlike(whole), _ntz(year, month, day, hour, zero(part(5)), zero(part(6))))


def coerce_ts(text, day_first: bool = False) -> Column:
    """Text -> timestamp_ntz, bad -> NULL, with no session time zone: the wall
    clock as written, a zone is dropped. Usual ISO texts are checked by one
    anchored match, their fields sit at fixed offsets (length 10: date, 16: +
    HH:mm, 19: + :ss, more: + fraction); any other layout goes by its pattern.
    ``day_first`` reads 3/4/2024 as 3 April (see ``votes_day_first``)."""
    t = strip_ws(text)
    n = F.length(t)
    part = lambda a, k, need: F.when(n >= need, F.substring(t, a, k)).otherwise(F.lit("0"))
    usual = _ntz(F.substring(t, 1, 4), F.substring(t, 6, 2), F.substring(t, 9, 2),
                 part(12, 2, 16), part(15, 2, 16), part(18, 9, 19))
    names = ["iso", "packed", "day first" if day_first else "month first", "named month first", "named month second"]
    return F.when(t.rlike(_TS_TEXT), usual).otherwise(let(t, lambda t: F.coalesce(*[_by_layout(t, name) for name in names])))


def coerce_date(text, day_first: bool = False) -> Column:
    return F.to_date(coerce_ts(text, day_first))


def votes_day_first(df, text_col: str) -> bool:
    """Whether a column's figures put the day first: some text can only be read
    that way, and none only the other way. One aggregate of two counts."""
    first = F.regexp_extract(strip_ws(F.col(text_col)), r"^([0-9]{1,2})[-/][0-9]{1,2}[-/][0-9]{4}", 1).try_cast("int")
    second = F.regexp_extract(strip_ws(F.col(text_col)), r"^[0-9]{1,2}[-/]([0-9]{1,2})[-/][0-9]{4}", 1).try_cast("int")
    got = df.agg(F.count_if(first.between(13, 31) & second.between(1, 12)).alias("day"),
                 F.count_if(second.between(13, 31) & first.between(1, 12)).alias("month")).first()
    return bool(got["day"] and not got["month"])


# R17 ------------------------------------------------------------------------
def strip_ws(x) -> Column:
    """Python ``str.strip()``: a character-set trim. Text between two visible
    ASCII characters is left alone, as the trim looks up every character."""
    visible = lambda at: F.substring(_c(x), at, 1).between("!", "~")
    return F.when(visible(1) & visible(-1), _c(x)).otherwise(F.btrim(_c(x), F.lit(PY_WS_CHARS)))


def symbol(x) -> Column:
    return F.upper(strip_ws(x))


# R18 ------------------------------------------------------------------------
def parse_param_date(text: str | None, default):
    """Parameter date ``yyyy-MM-dd``; bad or missing -> ``default``."""
    import datetime as _dt
    if text:
        try:
            return _dt.datetime.strptime(text, "%Y-%m-%d")
        except ValueError:
            pass
    return default


# R19 ------------------------------------------------------------------------
def plain_number(x) -> Column:
    """Text of a double as Python prints it: plain digits between 1e-4 and
    1e16 (never ``5.0E-4`` or ``1.2345678E7``), else like ``1e-05``."""
    d = _c(x).cast("double")
    text = d.cast("string")
    plain = F.regexp_replace(F.format_string("%s", d.try_cast("decimal(38,20)")), r"(\.[0-9]*?)0+$", "$1")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    power = F.element_at(F.split(text, "E"), -1).try_cast("int")
    short = F.format_string("%s%s%02d", F.regexp_replace(F.split(text, "E")[0], r"\.0$", ""),
                            F.when(power < 0, "e-").otherwise("e+"), F.abs(power))
    return (F.when(text.isNull() | ~text.contains("E"), text).when((F.abs(d) >= 1e-4) & (F.abs(d) < 1e16), plain).otherwise(short))


def wall_text(ts, fmt: str = "%04d-%02d-%02d %02d:%02d:%02d") -> Column:
    """Text of a timestamp_ntz from its fields (year, month, day, hour,
    minute, second, in that order; unused trailing fields are ignored).
    ``date_format`` would first move the value into the session time zone,
    which shifts wall times that fall in a DST gap."""
    ts = _c(ts)
    sec = F.floor(F.extract(F.lit("SECOND"), ts)).cast("int")
    text = F.format_string(fmt, F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), sec)
    return F.when(ts.isNotNull(), text)


def py_ts_text(ts) -> Column:
    """``str(pandas.Timestamp)``: seconds, plus 6 fraction digits if non-zero."""
    ts = _c(ts)
    micros = ((F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)) % F.lit(1_000_000)).cast("int")
    base = wall_text(ts)
    return F.when(micros != 0, F.concat(base, F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(base)


# R23 ------------------------------------------------------------------------
def micros_between(a, b) -> Column:
    """|a - b| in microseconds on wall-clock (timestamp_ntz) values."""
    return F.abs(F.timestamp_diff("MICROSECOND", _c(a).cast("timestamp_ntz"), _c(b).cast("timestamp_ntz")))
