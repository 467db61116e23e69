"""What makes a raw bar invalid, as column expressions: a reason, or null for a row to keep."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PRICES, CleanConfig

# Typed prices have 12 digits before the point and 8 after it: products of two stay exact in 38 digits.
PRICE = "decimal(20,8)"
_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?Z$"
_NOT_FINITE = r"(?i)^\s*[+-]?(s?nan[0-9]*|inf(inity)?)\s*$"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


#: Functions of a column, each of the one before's value, which it uses more than once.
Layers = Sequence[Callable[[Column], Column]]


def through(value: Column, layers: Layers) -> Column:
    """The last layer's value, with those before in variables of lambdas: an expression in a lambda is worked out at each place of its use."""
    return reduce(lambda v, layer: F.transform(F.array(v), layer)[0], layers, value)


def inline(value: Column, layers: Layers) -> Column:
    """The last layer's value without lambdas: compiled code shares expressions that occur twice, but not if a lambda is in them."""
    return reduce(lambda v, layer: layer(v), layers, value)


def is_blank(c: Column) -> Column:
    """Null, empty or only white space, also that beyond ASCII."""
    return F.coalesce(~c.rlike(r"(?U)\S"), F.lit(True))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def number(c: Column, kind: str = PRICE) -> Column:
    """The text as a decimal; null if it isn't a finite number."""
    return c.try_cast(kind)


def is_not_finite(c: Column) -> Column:
    return F.coalesce(c.rlike(_NOT_FINITE), F.lit(False))


def stamp(c: Column) -> Column:
    """A UTC time of form yyyy-MM-ddTHH:mm:ss[.fraction]Z at microseconds; null for any other text."""
    text = stripped(c)
    micros = F.rpad(F.substring(F.regexp_extract(text, r"\.([0-9]+)Z$", 1), 1, 6), 6, "0")
    moment = F.concat(F.substring(text, 1, 19), F.lit("."), micros).try_cast("timestamp_ntz")
    return F.when(text.rlike(_STAMP) & ~text.startswith("0000"), moment)


def past_micros(c: Column) -> Column:
    """Whether the text of a time has a fraction of a second that isn't 0."""
    return F.regexp_extract(stripped(c), r"\.([0-9]+)Z$", 1).rlike("[1-9]")


def stamp_reason(c: Column, config: CleanConfig) -> Column:
    return moment_reason(stamp(c), past_micros(c), config)


def moment_reason(ts: Column, fraction: Column, config: CleanConfig) -> Column:
    """stamp_reason() of a time and past_micros()."""
    within = ts.between(F.lit(config.first_utc).cast("timestamp_ntz"), F.lit(config.last_utc).cast("timestamp_ntz"))
    return (
        F.when(ts.isNull(), "INVALID_TIMESTAMP").when(~within, "TIMESTAMP_OUT_OF_RANGE")
        .when((F.second(ts) != 0) | fraction, "TIMESTAMP_NOT_MINUTE_ALIGNED")
    )


def definition_kind(fields: list[Column], config: CleanConfig) -> Column:
    """option, future or other by the definition fields that aren't blank; null if all are."""
    if not fields:
        return F.lit(None).cast("string")
    values = F.array_compact(F.array(*(F.when(~is_blank(c), F.upper(stripped(c))) for c in fields)))
    has = lambda names: F.arrays_overlap(values, F.array(*map(F.lit, names)))
    return F.when(F.size(values) == 0, F.lit(None)).when(has(config.option_values), "option").when(has(config.future_values), "future").otherwise("other")


def symbol_reason(symbol: Column, fields: list[Column], config: CleanConfig) -> Column:
    text, kind = F.upper(stripped(symbol)), definition_kind(fields, config)
    leg = f"{config.root}[{config.months}][0-9]{{1,2}}"
    strike = r"\s*[CP]\s*[0-9]+(\.[0-9]+)?"
    return (
        F.when(is_blank(symbol), "INVALID_SYMBOL").when(kind == "option", "OPTION_INSTRUMENT").when(kind == "other", "INVALID_PRODUCT")
        .when(text.rlike(f"^{leg}-{leg}$"), "FUTURES_SPREAD").when(text.rlike(f"^({leg}|{config.root}){strike}$"), "OPTION_INSTRUMENT")
        .when(text.rlike(f"^{leg}$"), F.lit(None)).when(text.rlike(f"^[A-Z]{{1,6}}[{config.months}][0-9]{{1,2}}$"), "INVALID_PRODUCT")
        .otherwise("INVALID_SYMBOL")
    )


#: A price that a PRICE holds as it is, and any number: digits, point, exponent of up to 18 digits.
_SIMPLE = r"^\s*[+-]?[0-9]{1,12}(\.[0-9]{0,8})?\s*$"
_ANY_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,18})?\s*$"
_POSITIVE = r"^\s*\+?[0-9.]*[1-9]"
_POSITIVE_NUMBER = r"^\s*\+?(?=[0-9.]*[1-9])([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,18})?\s*$"


def _all_match(pattern: str) -> Column:
    return F.forall(F.array(*(F.col(c) for c in PRICES)), lambda t: F.coalesce(t.rlike(pattern), F.lit(False)))


def simple() -> Column:
    """Whether decimals hold all four prices as they are; what is decided by them is decided by texts otherwise."""
    return _all_match(_SIMPLE)


#: White space of a regular expression, the ends of a line that its $ passes over, and the plus sign.
_AROUND = " \t\n\v\f\r\u0085\u2028\u2029+"


def _parts(text: Column) -> Column:
    mantissa = F.substring_index(text, "e", 1)
    exponent = F.when(text.contains("e"), F.substring_index(text, "e", -1).try_cast("long")).otherwise(F.lit(0).cast("long"))
    return F.struct((F.length(F.substring_index(mantissa, ".", 1)) + exponent).alias("point"), F.replace(mantissa, F.lit("."), F.lit("")).alias("digits"))


def _bare(number: Column) -> Column:
    digits = F.ltrim(number["digits"], F.lit("0"))
    return F.struct((number["point"] - F.length(number["digits"]) + F.length(digits)).alias("point"), F.rtrim(digits, F.lit("0")).alias("digits"))


#: Of a positive number's text, (point, digits): 0.digits times ten to the point, where digits starts and ends with none of
#: 0. So two numbers compare as their structs do, however long they are.
SCIENTIFIC: Layers = (lambda text: F.replace(F.trim(text, F.lit(_AROUND)), F.lit("E"), F.lit("e")), _parts, _bare)


def long_prices() -> Column:
    """SCIENTIFIC of the four prices; null where they are simple() or not all positive numbers."""
    return F.when(~simple() & _all_match(_POSITIVE_NUMBER), F.transform(F.array(*(F.col(c) for c in PRICES)), lambda t: through(t, SCIENTIFIC)))


def price_reason(odd: dict[str, Column] | None = None) -> Column:
    """Of the prices' texts, of any length. odd: whether they aren't finite, if that is known."""
    odd = odd or {c: is_not_finite(F.col(c)) for c in PRICES}
    number_text = {c: F.coalesce(F.col(c).rlike(_ANY_NUMBER), F.lit(False)) for c in PRICES}
    return F.when(~_all_match(_POSITIVE_NUMBER), (
        F.when(any_of([~odd[c] & ~number_text[c] for c in PRICES]), "INVALID_PRICE").when(any_of([odd[c] for c in PRICES]), "NON_FINITE_PRICE")
        .otherwise("NON_POSITIVE_PRICE")
    ))


def envelope_ok(o: Column, h: Column, l: Column, c: Column) -> Column:  # noqa: E741
    known = o.isNotNull() & c.isNotNull()  # least and greatest pass over nulls
    return F.coalesce(known & (l <= F.least(o, c)) & (F.greatest(o, c) <= h), F.lit(False))


def envelope_reason(prices: dict[str, Column] | None = None, long_ok: Column | None = None) -> Column:
    """Of the prices as decimals where they are simple(), of long_prices() where they aren't. long_ok: envelope_ok() of those, else null."""
    prices = prices or {c: number(F.col(c)) for c in PRICES}
    if long_ok is None:
        long_ok = through(long_prices(), [lambda e: F.when(e.isNotNull(), envelope_ok(*(e[i] for i in range(4))))])
    return F.when(~F.coalesce(long_ok, envelope_ok(*prices.values())), "INVALID_OHLC")


def _remainder(digits: Column, zeros: Column, by: int) -> Column:
    """The whole number of ``digits`` and then that many zeros, modulo ``by`` (under 10^12): some digits at a time, zeros by squares."""
    kind, some = "long" if by * by < 1 << 63 else "decimal(38,0)", 18 - len(str(by))

    def limbs(padded: Column) -> Column:
        starts = F.sequence(F.lit(0), F.length(padded) - some, F.lit(some))
        return F.transform(starts, lambda i: F.substring(padded, i + 1, F.lit(some)).try_cast("long"))

    add = lambda r, x: (r * 10**some + x) % by
    padded = F.lpad(digits, (F.ceil(F.length(digits) / some) * some).cast("int"), "0")
    long_head = F.aggregate(through(padded, [limbs]), F.lit(0).cast("long"), add)
    size, zero, three = F.length(digits), F.lit(0).cast("long"), F.lpad(digits, 3 * some, "0")
    head = (
        F.when(size > 3 * some, long_head).when(size > 18, reduce(add, [F.substring(three, i * some + 1, some).try_cast("long") for i in range(3)], zero))
        .when(size == 0, zero).otherwise(digits.try_cast("long") % by)
    )
    times = lambda a, b: (a * b % F.lit(by).cast(kind)).cast(kind)
    one = F.struct(F.lit(1).cast(kind).alias("power"), F.lit(10 % by).cast(kind).alias("base"), zeros.alias("left"))
    step = lambda s: F.struct(F.when(s["left"] % 2 == 1, times(s["power"], s["base"])).otherwise(s["power"]).alias("power"), times(s["base"], s["base"]).alias("base"), F.floor(s["left"] / 2).cast("long").alias("left"))
    power = F.aggregate(F.sequence(F.lit(1), F.length(F.bin(zeros))), one, lambda s, _: step(s))["power"]
    return F.when(zeros > 0, times(head.cast(kind), power).cast("long")).otherwise(head)


def _split(number: Decimal) -> tuple[int, str]:
    """The whole part, and the digits after the point without zeros at the end: those compare as texts do."""
    return int(number), format(number, "f").partition(".")[2].rstrip("0")


def off_grid(config: CleanConfig) -> Layers:
    """Whether a SCIENTIFIC price is off the grid by the tolerance or more.

    In units of 10^-8 the price has a whole part, whose remainder by the tick is exact, and digits after the point, which
    are compared as they are. Up to 18 zeros are put behind a whole part, so that few need _remainder()'s squares.
    """
    tick, allowed = int(config.tick.scaleb(8)), config.tick.scaleb(8) * config.tick_tolerance
    (near, near_digits), (far, far_digits) = _split(allowed), _split(tick - allowed)
    few = max(len(near_digits), len(far_digits)) + 1

    def cut(price: Column) -> Column:
        digits, n = price["digits"], price["point"] + 8
        size = F.length(digits)
        whole = F.rpad(digits, F.greatest(F.least(n, size + 18), F.lit(0)).cast("int"), "0")
        after = F.when(n >= size, "").when(n >= 0, F.substring(digits, (n + 1).cast("int"), size)).otherwise(F.concat(F.repeat(F.lit("0"), F.least(-n, F.lit(few)).cast("int")), digits))
        return F.struct(whole.alias("whole"), F.greatest(n - size - 18, F.lit(0)).alias("zeros"), after.alias("after"))

    def beyond(price: Column) -> Column:
        return F.struct(_remainder(price["whole"], price["zeros"], tick).alias("units"), price["after"].alias("after"))

    def off(b: Column) -> Column:
        units, after = b["units"], b["after"]
        return ~((units < near) | ((units == near) & (after < near_digits)) | (units > far) | ((units == far) & (after > far_digits)))

    return cut, beyond, off


def tick_reason(config: CleanConfig, prices: dict[str, Column] | None = None, long_off: Column | None = None) -> Column:
    """A price off the grid by the tolerance (in ticks) or more. long_off: whether one of long_prices() is, else null.

    Doubles decide where their error can't matter; the others are decided by exact decimals, which are slow, and
    prices that decimals don't hold by their digits.
    """
    tick = F.lit(config.tick).cast("decimal(12,8)")
    allowed = F.lit(config.tick * config.tick_tolerance).cast("decimal(20,16)")
    long_off = F.exists(long_prices(), lambda p: through(p, off_grid(config))) if long_off is None else long_off

    def off(price: Column) -> Column:
        beyond = F.abs(price) % tick
        decided = F.coalesce(~(F.least(beyond, tick - beyond) < allowed), F.lit(True))
        ticks = F.abs(price.cast("double")) / float(config.tick)
        away, error = F.abs(ticks - F.rint(ticks)), ticks * 1e-14 + 1e-12
        tolerance = float(config.tick_tolerance)
        return F.when(away + error < tolerance, False).when(away - error > tolerance, True).otherwise(decided)

    usual = any_of([off(p) for p in (prices or {c: number(F.col(c)) for c in PRICES}).values()])
    return F.when(F.coalesce(long_off, usual), "INVALID_TICK_SIZE")


#: A volume has 18 decimals and 20 digits before them as a decimal; larger ones are known by their text and as a double.
WHOLE = "decimal(38,18)"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_FRACTION = r"^\s*[+-]?[0-9]*\.[0-9]*[1-9][0-9]*\s*$"


def volume_reason(text: Column | None = None) -> Column:
    text = F.col("volume") if text is None else text
    exact, rough = number(text, WHOLE), F.when(text.rlike(_NUMBER), text.try_cast("double"))
    negative = F.when(exact.isNotNull(), exact < 0).otherwise(rough < 0)
    return (
        F.when(exact.isNull() & (rough.isNull() | (F.abs(rough) == float("inf"))), "INVALID_VOLUME").when(negative, "NEGATIVE_VOLUME")
        .when(text.rlike(_FRACTION) | F.coalesce(exact != F.floor(exact), F.lit(False)), "NON_INTEGER_VOLUME")
    )
