"""Scalar functions, each ``Column -> Column`` over Spark built-ins (no Python UDF)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each agency publishes in place of a number.
FRED_MISSING = (".",)
BEA_MISSING = ("", "(D)", "(NA)", "...")
BLS_MISSING = ("-", "", "N/A")

# Frequency name of a period letter.
FREQUENCY_OF_LETTER = {"M": "monthly", "Q": "quarterly", "A": "annual", "S": "semi_annual"}

# Where a quarter begins.
QUARTER_START = {"1": "-01-01", "2": "-04-01", "3": "-07-01", "4": "-10-01"}

# Plain decimal or scientific notation, or an infinity. Refuses 'nan', '1_000' and '1.5d',
# on which number parsers of different languages disagree.
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"

# Texts read as a date: the shape of the text, and how to make ``yyyy-MM-dd`` of it. The shape is
# tested first, since a failed parse is far dearer than a failed match.
DATE_SHAPES = (
    (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$", lambda c: F.substring(c, 1, 10)),
    (r"^\d{8}$", lambda c: F.regexp_replace(c, r"(\d{4})(\d{2})(\d{2})", "$1-$2-$3")),
    (r"^\d{2}/\d{2}/\d{4}$", lambda c: F.regexp_replace(c, r"(\d{2})/(\d{2})/(\d{4})", "$3-$1-$2")),
    (r"^\d{4}-\d{2}$", lambda c: F.concat(c, F.lit("-01"))),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str, tokens: Sequence[str]) -> Column:
    """Null where the text is one of the publisher's missing marks."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def safe_double(c: Column | str) -> Column:
    """Text to double; anything that is not a number, and NaN, becomes null. Infinity stays."""
    c = _col(c)
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def parse_thousands(c: Column | str) -> Column:
    """``safe_double`` of a number written with thousands separators."""
    return safe_double(F.replace(_col(c), F.lit(","), F.lit("")))


def _choice(key: Column, choices: Mapping[str, object]) -> Column:
    """Value of a small fixed map; null for a key it lacks."""
    pairs = [F.lit(x) for pair in choices.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def _two_digits(month: Column) -> Column:
    return F.lpad(month, 2, "0")


def parse_period_compact(period: Column | str, frequency: Column | str) -> Column:
    """Date of ``2023`` (A), ``2023Q1`` (Q) or ``2023M01`` (M); null when it is none of these.

    Read by position: four characters of year, one that is skipped, the rest.
    """
    period, frequency = _col(period), _col(frequency)
    year = F.substring(period, 1, 4)
    iso = (
        F.when(frequency == "A", F.concat(period, F.lit("-01-01")))
        .when(frequency == "Q", F.concat(year, _choice(F.substring(period, 6, 1), QUARTER_START)))
        .when(frequency == "M", F.concat(year, F.lit("-"), _two_digits(F.substring(period, 6, 2)), F.lit("-01")))
    )
    return iso.try_cast("date")


def _coded_months() -> dict[str, str]:
    """First days of the usual codes, by rule: ``M01``-``M12``, ``Q01``-``Q04``, ``A01``, ``S01``, ``S02``."""
    first = {f"M{m:02d}": m for m in range(1, 13)} | {f"Q{q:02d}": 3 * q - 2 for q in range(1, 5)}
    return {code: f"-{m:02d}-01" for code, m in (first | {"A01": 1, "S01": 1, "S02": 7}).items()}


def _odd_coded_month(period: Column) -> Column:
    """The same for codes written otherwise: small letters, other digits, any ``A``."""
    letter, number = F.upper(F.substring(period, 1, 1)), F.substring(period, 2, 9).try_cast("int")
    month = (
        F.when((letter == "M") & number.between(1, 12), number)
        .when((letter == "Q") & number.between(1, 4), number * 3 - 2)
        .when((letter == "A") & number.isNotNull(), 1)
        .when((letter == "S") & number.between(1, 2), number * 6 - 5)
    )
    return F.concat(F.lit("-"), _two_digits(month.cast("string")), F.lit("-01"))


def parse_period_coded(year: Column | str, period: Column | str) -> Column:
    """Date of a year plus a code: ``M01``-``M12``, ``Q01``-``Q04``, any ``A``, ``S01``/``S02``.

    The usual codes are looked up; only others are taken apart.
    """
    year, period = _col(year), _col(period)
    # the code is named once in each branch, as it may be an expression of its own
    odd = F.transform(F.array(period), _odd_coded_month)[0]
    start = F.coalesce(_choice(period, _coded_months()), odd)
    return F.concat(year, start).try_cast("date")


def infer_frequency(period: Column | str) -> Column:
    """Frequency name from the letter of a period code."""
    letter = F.upper(F.substring(_col(period), 1, 1))
    return F.coalesce(_choice(letter, FREQUENCY_OF_LETTER), F.lit("unknown"))


# Texts of other shapes: the signature of the text (Y four digits, n one or two, A letters, separators as
# they are), and where its year, month and day stand among its runs of digits or letters (0: the first).
DATE_GRAMMAR = (
    {f"Y{x}n{x}n": "123" for x in "-/. "}
    | {f"n{x}n{x}Y": "312" for x in "-/. "}  # month first; the day, if the number is beyond twelve
    | {f"Y{x}n": "120" for x in "/. "}
    | {f"n{x}Y": "210" for x in "-/. "}
    | {"Y": "100", "A n, Y": "312", "A n Y": "312", "A. n, Y": "312", "A Y": "210", "A, Y": "210", "A-Y": "210", "Y A": "120"}
    | {f"n{x}A{x}Y": "321" for x in "- /"}
    | {"n A. Y": "321", "n A, Y": "321", "Y-A-n": "123", "Y A n": "123"}
)
# Names of the months, by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_TIME_OF_DAY = r"(?i)[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AP]M)?( ?(Z|UTC|GMT|[+-]\d{2}:?\d{2}))?$"


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value computed once, however often it is named."""
    return F.transform(F.array(value), of)[0]


def _date_by_grammar(text: Column) -> Column:
    """``yyyy-MM-dd`` of a text whose signature is in the grammar; the time of day is left out."""
    return _bound(F.regexp_replace(F.trim(text), _TIME_OF_DAY, ""), _date_of_day_text)


def _date_of_day_text(day_text: Column) -> Column:
    signature = F.regexp_replace(day_text, r"[A-Za-z]+", "A")
    signature = F.regexp_replace(F.regexp_replace(signature, r"(?<!\d)\d{4}(?!\d)", "Y"), r"(?<!\d)\d{1,2}(?!\d)", "n")
    where = _choice(signature, DATE_GRAMMAR)
    parts = F.regexp_extract_all(day_text, F.lit("[0-9]+|[A-Za-z]+"), F.lit(0))

    def part(found: Column, position: int) -> Column:
        at = F.substring(found["where"], position, 1).try_cast("int")
        return F.when(at > 0, F.try_element_at(found["parts"], at)).when(at == 0, "1")

    # texts of no known signature are not taken apart
    return _bound(
        F.when(where.isNotNull(), F.struct(where.alias("where"), parts.alias("parts"))),
        lambda found: _bound(
            F.struct(found["where"].alias("where"), *[part(found, i).alias(f"p{i}") for i in (1, 2, 3)]), _date_of_parts
        ),
    )


def _date_of_parts(found: Column) -> Column:
    middle = found["p2"]
    named = _choice(F.lower(F.substring(middle, 1, 3)), {m: str(i) for i, m in enumerate(MONTHS, 1)})
    spelt = middle.rlike(r"(?i)^(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)$")
    month = F.when(middle.rlike(r"^\d+$"), middle).when(spelt, named)

    def day(month: Column) -> Column:
        swapped = (found["where"] == "312") & (month.try_cast("int") > 12)  # thirteen and more is a day
        first, second = F.when(swapped, found["p3"]).otherwise(month), F.when(swapped, month).otherwise(found["p3"])
        return F.concat(found["p1"], F.lit("-"), _two_digits(first), F.lit("-"), _two_digits(second))

    return _bound(month, day)


def normalize_date(c: Column | str, shapes=DATE_SHAPES) -> Column:
    """The date a text stands for; null when it has no known shape or is no real day.

    The usual shapes are tried first, others go by their signature: one look-up
    says where year, month and day stand. ``1/2/2020`` is read month first, as
    ``13/2/2020`` cannot be. Years of two digits, six digits in a row and
    quarters stand for no one day and are not read.
    """

    def iso_of(text: Column) -> Column:
        iso = F.when(text.isNull(), F.lit(None).cast("string"))
        for shape, to_iso in shapes:
            iso = iso.when(text.rlike(shape), to_iso(text))
        return iso.otherwise(_date_by_grammar(text))

    # bound once, as the text may be an expression of its own
    return _bound(_col(c), iso_of).try_cast("date")


def numeric_year(c: Column | str) -> Column:
    """The year when the text is all digits, else null."""
    c = _col(c)
    return F.when(c.rlike(r"^\d+$"), c.try_cast("int"))


def period_start(c: Column | str, grain: str) -> Column:
    """First day of the week, month, quarter or year of a date."""
    return F.trunc(_col(c).cast("date"), grain)


def series_url(c: Column | str, base: str) -> Column:
    return F.concat(F.lit(base), _col(c))


def join_codes(notes: Column | str, field: str = "code") -> Column:
    """Comma list of the non-empty codes of an array of structs; null when there are none."""
    codes = F.transform(_col(notes), lambda n: n[field])
    kept = F.filter(codes, lambda code: code.isNotNull() & (code != ""))
    return F.nullif(F.array_join(kept, ","), F.lit(""))


def content_hash(payload: Column | str, length: int = 8) -> Column:
    """Leading hex digits of the MD5 of a document's text."""
    return F.substring(F.md5(_col(payload)), 1, length)


def missing_flag(flag: Column | str, value: Column | str) -> Column:
    """The publisher's flag where it gave one, otherwise whether the value is null."""
    return F.coalesce(_col(flag), _col(value).isNull())


def negative_flag(c: Column | str) -> Column:
    """Whether a number is below zero; unknown counts as no."""
    return F.coalesce(_col(c) < 0, F.lit(False))


def complete_flag(cols: Sequence[Column | str]) -> Column:
    """Whether none of the columns is null."""
    flag = F.lit(True)
    for c in cols:
        flag = flag & _col(c).isNotNull()
    return flag


def decimal_double(c: Column | str, scale: int = 2) -> Column:
    """Fixed-point copy of a double, so that sums do not depend on the order of rows."""
    return _col(c).cast(f"decimal(18,{scale})")
