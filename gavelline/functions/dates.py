"""Date parsing with an ordered list of formats."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelline.functions.text import clean_text, once, strip

# Accepted date formats, tried in this order.  The pattern in front of each keeps texts of another
# shape away from the parser, so that no row pays for a failed parse.
_FORMATS = [
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}:\d{1,6}$", "d/M/yyyy H:m:s"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
]

# Shapes of other texts once weekdays, times, ordinal endings and filling words are gone, digits and letters stand apart,
# separators are spaces and years have four digits.  A month in digits comes first where both readings are days.
_LOOSE_FORMATS = [
    (r"^\d{4} \d{1,2} \d{1,2}$", "yyyy M d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^\d{4} [A-Za-z]{4,9} \d{1,2}$", "yyyy MMMM d"),
    (r"^\d{4} [A-Za-z]{3} \d{1,2}$", "yyyy MMM d"),
    (r"^\d{1,2} \d{1,2} \d{4}$", "M d yyyy"),
    (r"^\d{1,2} \d{1,2} \d{4}$", "d M yyyy"),
    (r"^[A-Za-z]{4,9} \d{4}$", "MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{4}$", "MMM yyyy"),
    (r"^\d{4} \d{1,2}$", "yyyy M"),
    (r"^\d{1,2} \d{4}$", "M yyyy"),
]
_WEEKDAY = r"(?i)\b(mon|tues?|wed(nes)?|thu(rs?)?|fri|sat(ur)?|sun)(day)?\b"
# A time of day, wherever it stands, with its zone; one that is no time stays and spoils the text's shape.
_TIME = (
    r"(?i)(^|[\sT])([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,9})?)?(\s*[ap]m\b)?(\s*(Z|GMT|UTC|[+-]\d{2}:?\d{2})(?=\s|$))?"
)
_STAMP = r"^(\d{8})T\d{4}(\d{2})?Z?$"
_FILLING = r"(?i)\b(of|at|ad)\b"
# Two-digit years of this century.
_SHORT_YEAR_2000 = "([0-6][0-9]|7[0-5])"
_ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([+-]\d{2}:\d{2}|Z)?$"


def _guarded(text: Column, shape: str, pattern: str) -> Column:
    return F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)).cast("date"))


def _tidy(t: Column) -> Column:
    """Day, month and year with single spaces, as far as the text has them."""
    for pattern, instead in (
        (_STAMP, "$1"), (_TIME, " "), (_WEEKDAY, " "), (r"(?i)\b(\d{1,2})(st|nd|rd|th)\b", "$1"), (_FILLING, " "),
        (r"(?<=\d)(?=[A-Za-z])|(?<=[A-Za-z])(?=\d)", " "), (r"(?i)\bsept\b", "Sep"), (r"[,./;'\s-]+", " "),
    ):
        t = F.regexp_replace(t, pattern, instead)
    head = r"^(\d{1,2} (?:\d{1,2}|[A-Za-z]{3,9})|[A-Za-z]{3,9} \d{1,2}) "
    return F.regexp_replace(F.regexp_replace(F.trim(t), head + _SHORT_YEAR_2000 + "$", "$1 20$2"), head + r"(\d{2})$", "$1 19$2")


def parse_date(c: Column) -> Column:
    """Text to date: noise is null, then the formats in order, then the loose shapes, else null."""
    t = strip(c)
    # the fraction after the third colon does not move the day
    seconds = F.regexp_replace(t, r"(\d{1,2}:\d{1,2}:\d{1,2}):\d{1,6}$", "$1")
    day_month_time, *others = _FORMATS
    tries = [F.when(t.rlike(day_month_time[0]), F.try_to_timestamp(seconds, F.lit(day_month_time[1])).cast("date"))]
    tries += [_guarded(t, shape, pattern) for shape, pattern in others]
    tries.append(once(_tidy(t), lambda x: F.coalesce(*[_guarded(x, shape, pattern) for shape, pattern in _LOOSE_FORMATS])))
    tries.append(F.when(t.rlike(_ISO_TIMESTAMP), F.substring(t, 1, 10).try_cast("date")))
    return F.when(clean_text(c).isNotNull(), F.coalesce(*tries))


def serial_date(c: Column) -> Column:
    """Spreadsheet day number to date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(c).cast("int"))


def parse_date_or_serial(c: Column) -> Column:
    """Date from text, where a bare number in the text is a spreadsheet day number."""
    t = strip(c)
    number = F.when(t.rlike(r"^\d{1,6}(\.\d+)?$"), t.try_cast("double"))
    return F.coalesce(serial_date(number), parse_date(c))


def display_date(article_date: Column, scraped: Column) -> Column:
    """ISO article date as 'dd MMM yyyy', other article dates as they are, else the day the row was scraped."""
    raw = strip(article_date)
    iso_day = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), raw.try_cast("date"))
    iso_time = F.when(raw.rlike(_ISO_TIMESTAMP), F.substring(raw, 1, 10).try_cast("date"))
    shown = F.date_format(F.coalesce(iso_day, iso_time), "dd MMM yyyy")
    return F.coalesce(shown, F.nullif(raw, F.lit("")), F.date_format(scraped, "dd MMM yyyy"), F.lit(""))
