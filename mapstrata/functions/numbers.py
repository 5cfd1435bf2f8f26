"""Number recognition, quantile arithmetic and number texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.text import stripped

# How a number may be written, and the smallest and largest integer accepted.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITY_PATTERN = r"^(?i)[+-]?inf(inity)?$"
INTEGER_PATTERN = r"^[+-]?\d+$"
SMALLEST_INTEGER = "-9223372036854775808"
LARGEST_INTEGER = "18446744073709551615"


# Any number below this size is in range, so that exact integers are rarely looked at.
SURELY_IN_RANGE = 9.2e18


def is_number_text(text: Column) -> Column:
    """True when already stripped text reads as a number in range."""
    size = F.abs(text.try_cast("double"))
    lowest, highest = (F.lit(bound).cast("decimal(38,0)") for bound in (SMALLEST_INTEGER, LARGEST_INTEGER))
    integer = text.try_cast("decimal(38,0)")
    integer_in_range = F.coalesce((integer >= lowest) & (integer <= highest), F.lit(False))
    in_range = (
        F.when(size < SURELY_IN_RANGE, True)
        .when(text.rlike(INTEGER_PATTERN), integer_in_range)
        .otherwise(size < float("inf"))
    )
    return F.when(text.rlike(NUMBER_PATTERN), in_range).otherwise(text.rlike(INFINITY_PATTERN))


def is_numeric_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def as_double(value: Column, data_type: T.DataType) -> Column:
    """Number of a column that passed the numeric gate; NaN counts as missing."""
    if isinstance(data_type, T.StringType):
        return stripped(value).try_cast("double")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = value.cast("double")
        return F.when(~F.isnan(number), number)
    return value.cast("double")


def as_integer(value: Column, data_type: T.DataType) -> Column:
    """Exact integer of a column that holds integers only."""
    return (stripped(value) if isinstance(data_type, T.StringType) else value).cast("decimal(20,0)")


def finite_or_fail(value: Column) -> Column:
    failure = F.raise_error(F.lit("infinite values cannot be binned"))
    return F.when(F.abs(value) == float("inf"), failure).otherwise(value)


def percent(value: Column) -> Column:
    """Percentage with one decimal, halves to even."""
    return F.rint(value * 100 * 10) / 10


def rounded_to_significant(value: Column, precision: Column) -> Column:
    """``precision`` decimals, counted from the first significant one for values below 1."""
    leading = -F.floor(F.log10(F.abs(value))) - 1 + precision
    digits = F.when(F.abs(value) >= 1, precision).otherwise(leading)
    scale = F.pow(F.lit(10.0), digits.cast("double"))
    return F.when(value == 0, value).otherwise(F.rint(value * scale) / scale)


def _named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# In this range the engine's text may end in a digit beside the nearest one; its numbers are integers that decimals hold.
ROUNDED_FROM, ROUNDED_BELOW = 1e17, 1e37
DIGITS = "decimal(38,0)"

# So many digits name every double.
MOST_DIGITS = 17


def _exact(size: Column) -> Column:
    """The integer that a number of this range is."""
    top = F.floor(size / 2.0**64)
    rest = size - top.cast("double") * 2.0**64
    middle = F.floor(rest / 2.0**32)
    low = rest - middle.cast("double") * 2.0**32
    power = {k: F.lit(str(1 << k)).cast("decimal(20,0)") for k in (32, 64)}
    wide = [(part.cast("bigint").cast("decimal(18,0)") * factor).cast(DIGITS) for part, factor in ((top, power[64]), (middle, power[32]))]
    return (wide[0] + wide[1] + low.cast("bigint").cast("decimal(18,0)")).cast(DIGITS)


def _digits(size: Column) -> Column:
    """``d`` (digits as an integer), ``n`` (how many) and ``s`` (exponent of the first one) of the engine's text, which names the
    number but need not be the shortest text that does, or of the number itself where it is known."""
    raw = size.cast("string")
    exponent = F.when(raw.contains("E"), F.substring_index(raw, "E", -1).cast("int")).otherwise(0)
    mantissa = F.substring_index(raw, "E", 1)

    def parts(m: Column) -> Column:
        whole, fraction = F.substring_index(m["text"], ".", 1), F.substring_index(m["text"], ".", -1)
        every = F.concat(whole, fraction)
        held = F.regexp_replace(every, "^0+", "")
        first = F.length(whole) + m["exponent"] - 1 - (F.length(every) - F.length(held))
        return F.struct(F.regexp_replace(held, "0+$", "").alias("text"), first.alias("s"))

    def numbered(p: Column) -> Column:
        n = F.length(p["text"])
        known = (n >= 16) & (size >= ROUNDED_FROM) & (size < ROUNDED_BELOW)
        return F.struct(
            F.when(known, _exact(size)).otherwise(p["text"].cast(DIGITS)).alias("d"), F.when(known, p["s"] + 1).otherwise(n).alias("n"), p["s"].alias("s")
        )

    return _named(_named(F.struct(mantissa.alias("text"), exponent.alias("exponent")), parts), numbered)


def _shortest(size: Column) -> Column:
    """``text`` (digits) and ``s`` (exponent of the first one) of the shortest number that reads as ``size``."""

    def candidates(p: Column, k: Column) -> Column:
        """The two numbers of ``k`` digits around it, the nearer one first, halves to even. Below a power of two doubles lie
        closer, so that the other one may read as it and the nearer one not."""

        def around(u: Column) -> Column:
            def ordered(q: Column) -> Column:
                twice = ((p["d"] - q.cast(DIGITS) * u).cast(DIGITS) * 2).cast(DIGITS)
                above = (twice > u) | ((twice == u) & (q % 2 == 1))
                return F.when(above, F.array(q + 1, q)).otherwise(F.array(q, q + 1))

            return _named(F.call_function("div", p["d"], u), ordered)

        unit = F.concat(F.lit("1"), F.repeat(F.lit("0"), p["n"] - k)).cast(DIGITS)
        return F.transform(_named(unit, around), lambda q: F.struct(q.alias("q"), (p["s"] - k + 1).alias("e")))

    def reads(c: Column) -> Column:
        return F.concat(c["q"].cast("string"), F.lit("E"), c["e"].cast("string")).try_cast("double") == size

    def chosen(p: Column) -> Column:
        # two numbers of 15 digits never read as one double that has all its bits, so a shorter text is one of 15 with zeros
        first = F.when(size < 1e-300, 1).otherwise(F.least(p["n"], F.lit(15)))
        tried = F.flatten(F.transform(F.sequence(first, F.least(p["n"], F.lit(MOST_DIGITS))), lambda k: candidates(p, k)))
        return F.get(F.filter(tried, reads), F.lit(0))

    def trimmed(c: Column) -> Column:
        text = c["q"].cast("string")
        return F.struct(F.regexp_replace(text, "0+$", "").alias("text"), (F.length(text) - 1 + c["e"]).alias("s"))

    return _named(_named(_digits(size), chosen), trimmed)


def float_text(value: Column) -> Column:
    """Shortest text that reads as the same double, in the usual form: ``0.001``, ``12.5``, ``10000000.0``, ``1e-05``, ``1e+17``."""

    def written(t: Column) -> Column:
        text, s, zeros = t["text"], t["s"], lambda n: F.repeat(F.lit("0"), n)
        n = F.length(text)
        small = F.concat(F.lit("0."), zeros(-s - 1), text)
        large = F.concat(text, zeros(s - n + 1), F.lit(".0"))
        between = F.concat(F.substring(text, F.lit(1), s + 1), F.lit("."), F.substring(text, s + 2, n))
        exponent = F.abs(s).cast("string")
        scientific = F.concat(
            F.substring(text, 1, 1),
            F.when(n > 1, F.concat(F.lit("."), F.substring(text, F.lit(2), n))).otherwise(""),
            F.when(s < 0, "e-").otherwise("e+"),
            F.when(F.length(exponent) < 2, F.lpad(exponent, 2, "0")).otherwise(exponent),
        )
        return (
            F.when((s < -4) | (s >= 16), scientific).when(s < 0, small).when(s >= n - 1, large).otherwise(between)
        )

    def signed(x: Column) -> Column:
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        return F.concat(sign, F.when(F.abs(x) == float("inf"), "inf").otherwise(_named(_shortest(F.abs(x)), written)))

    return (
        F.when(F.isnan(value), "nan")
        .when(_is_shortest(value), _engine_text(value))
        .otherwise(_named(value.cast("double"), signed))
    )


def _is_shortest(value: Column) -> Column:
    """Whether the engine's digits are surely the shortest ones: up to 15 of them, of a number that has all its bits."""
    mantissa = F.substring_index(F.abs(value).cast("string"), "E", 1)
    return (F.length(mantissa) <= 16) & ((F.abs(value) >= 1e-300) | (value == 0)) & (F.abs(value) < float("inf"))


def _engine_text(value: Column) -> Column:
    """The engine's digits in the usual form."""
    size = F.abs(value)
    raw = value.cast("string")
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    exponent = F.substring_index(raw, "E", -1)
    sign = F.when(exponent.startswith("-"), "-").otherwise("+")
    digits = F.regexp_replace(exponent, "^-", "")
    scientific = F.concat(mantissa, F.lit("e"), sign, F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))
    return (
        F.when(raw == "-0.0", "-0.0")
        .when(value == 0, "0.0")
        .when((size >= 1e-4) & (size < 1e16), F.call_function("format_number", value, F.lit("0.0" + "#" * 24)))
        .otherwise(scientific)
    )
