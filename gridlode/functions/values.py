"""Numbers, dates and hashes with the exact text forms that keys are built on."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlode.functions.text import filled, fold, nfkc


def _formatted(x: Column, form: str) -> Column:
    return F.call_function("format_number", x, F.lit(form))


def _scientific(x: Column, digits: int) -> Column:
    """A finite double to so many significant digits, as d.ddde+xx."""
    return F.format_string(f"%.{digits - 1}e", x)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once and its code apart."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _laid_out(text: Column, widest: int, point: str) -> Column:
    """d.ddde+xx without trailing zeros: plain from 1e-4 to 10^widest, `point` behind whole numbers there, else with an exponent."""
    zeros = lambda n: F.repeat(F.lit("0"), n)

    def put(n: Column) -> Column:
        digits, e = n["digits"], n["e"]
        plain = (
            F.when(e < 0, F.concat(F.lit("0."), zeros(-e - 1), digits))
            .when(F.length(digits) <= e + 1, F.concat(digits, zeros(e + 1 - F.length(digits)), F.lit(point)))
            .otherwise(F.concat(F.substr(digits, F.lit(1), e + 1), F.lit("."), F.substr(digits, e + 2)))
        )
        more = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, 20))).otherwise("")
        power_ = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
        return F.concat(n["sign"], F.when((e < -4) | (e >= widest), F.concat(F.substring(digits, 1, 1), more, power_)).otherwise(plain))

    def read(t: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(F.substring_index(t, "e", 1), "[-.]", ""), "(?<=.)0+$", "")
        sign = F.when(F.startswith(t, F.lit("-")), "-").otherwise("")
        return _let(F.struct(sign.alias("sign"), digits.alias("digits"), F.substring_index(t, "e", -1).try_cast("int").alias("e")), put)

    return _let(text, read)


def _whole(x: Column, below: float, point: str) -> Column:
    """The text of a whole number under a bound, which most are; null for others."""
    return F.when((x == F.floor(x).cast("double")) & (F.abs(x) < below) & (x != 0), F.concat(x.cast("bigint").cast("string"), F.lit(point)))


def _special(x: Column, nan: str, infinity: str) -> Column:
    return F.when(F.isnan(x), nan).when(x == float("inf"), infinity).when(x == float("-inf"), f"-{infinity}")


def float_text(x: Column) -> Column:
    """Shortest text of a double that reads back as the same, as JSON has it; plain from 1e-4 to 1e16."""

    def shortest(v: Column) -> Column:
        tries = F.array(*(_scientific(v, digits) for digits in (15, 16, 17)))
        return _laid_out(F.get(F.filter(tries, lambda t: t.try_cast("double") == v), 0), 16, ".0")

    return F.when(x.isNotNull(), F.coalesce(_special(x, "NaN", "Infinity"), _whole(x, 1e15, ".0"), _let(x, shortest)))


_LIMB = 1_000_000_000


def _div(a: Column, b: int | Column) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint") if isinstance(b, int) else b)


def _times(number: Column, factors: Column) -> Column:
    """A whole number of any size, as limbs of nine digits from the lowest up, times each of the factors (under 2^31)."""
    zero = F.struct(F.array().cast("array<bigint>").alias("limbs"), F.lit(0).cast("bigint").alias("carry"))

    def step(factor: Column):
        return lambda acc, limb: _let(limb * factor + acc["carry"], lambda t: F.struct(F.array_append(acc["limbs"], t % _LIMB).alias("limbs"), _div(t, _LIMB).alias("carry")))

    return F.aggregate(factors, number, lambda limbs, factor: F.aggregate(limbs, zero, step(factor), lambda acc: F.when(acc["carry"] > 0, F.array_append(acc["limbs"], acc["carry"])).otherwise(acc["limbs"])))


def _over(number: Column, divisors: Column) -> Column:
    """struct(limbs, more): the whole part of a number over each of the divisors, and whether anything is left."""
    zero = F.struct(F.array().cast("array<bigint>").alias("limbs"), F.lit(0).cast("bigint").alias("rest"))

    def step(by: Column):
        return lambda acc, limb: _let(acc["rest"] * _LIMB + limb, lambda t: F.struct(F.array_append(acc["limbs"], _div(t, by)).alias("limbs"), (t % by).alias("rest")))

    def once(acc: Column, by: Column) -> Column:
        return F.aggregate(F.reverse(acc["limbs"]), zero, step(by), lambda q: F.struct(F.reverse(q["limbs"]).alias("limbs"), (acc["more"] | (q["rest"] > 0)).alias("more")))

    return F.aggregate(divisors, F.struct(number.alias("limbs"), F.lit(False).alias("more")), once)


def _powers(base: int, most: int, n: Column) -> Column:
    """base^n as factors of base^most at most; of n under 0 none but 1."""
    n = F.greatest(n, F.lit(0))
    table = F.array(*(F.lit(base**k).cast("bigint") for k in range(most)))
    return F.concat(F.array_repeat(F.lit(base**most).cast("bigint"), F.floor(n / most).cast("int")), F.array(F.get(table, (n % most).cast("int"))))


def _exact(x: Column, digits: int) -> Column:
    """struct(n, e): the nearest n * 10^(e + 1 - digits) to a positive double, n of so many digits, ties to even n.

    x is m / 2^s for whole m and s. Whole numbers of any size give x * 10^p, of one
    to three digits more than are asked for, and whether anything is left behind it.
    """

    def scaled(v: Column) -> Column:
        s = F.least(F.lit(53) - F.floor(F.log2(v)).cast("int"), F.lit(1074))
        half = F.floor(s / 2).cast("int")
        whole = (v * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), s - half)).cast("bigint")  # powers of 2 are exact
        return F.struct(whole.alias("m"), s.alias("s"), (F.lit(digits + 1) - F.floor(F.log10(v)).cast("int")).alias("p"))

    def divided(n: Column) -> Column:
        limbs = F.array(n["m"] % _LIMB, _div(n["m"], _LIMB) % _LIMB, _div(n["m"], _LIMB * _LIMB))
        made = _times(_times(limbs, _powers(10, 9, n["p"])), _powers(2, 30, -n["s"]))
        left = _over(made, F.concat(_powers(2, 30, n["s"]), _powers(10, 9, -n["p"])))
        return _let(F.struct(left.alias("q"), n["p"].alias("p")), lambda d: F.struct((F.get(d["q"]["limbs"], 0) + F.coalesce(F.get(d["q"]["limbs"], 1), F.lit(0)) * _LIMB).alias("q"), d["q"]["more"].alias("more"), d["p"].alias("p")))

    def cut(r: Column) -> Column:
        size = F.length(r["q"].cast("string"))
        unit = F.pow(F.lit(10.0), size - digits).cast("bigint")
        return F.struct(_div(r["q"], unit).alias("n"), (2 * (r["q"] % unit) - unit).alias("above"), r["more"].alias("more"), (size - 1 - r["p"]).alias("e"))

    def nearest(c: Column) -> Column:
        up = (c["above"] > 0) | ((c["above"] == 0) & (c["more"] | (c["n"] % 2 == 1)))
        return F.struct((c["n"] + F.when(up, 1).otherwise(0)).alias("n"), c["e"].alias("e"))

    return _let(x, lambda v: _let(scaled(v), lambda n: _let(divided(n), lambda r: _let(cut(r), nearest))))


_SMALLEST_NORMAL = 2.2250738585072014e-308


def _rounded(x: Column, digits: int) -> Column:
    """A finite double to so many significant digits, as d.ddde+xx, by its binary value, ties to even.

    The platform's 17 digits are off by a few units in the last place at most. Where what they
    have after `digits` is that close to a half, and for subnormal numbers, of which they have
    fewer, whole numbers decide.
    """
    half = 5 * 10 ** (16 - digits)

    def read(t: Column) -> Column:
        mantissa = F.regexp_replace(F.substring_index(t["t"], "e", 1), "[-.]", "")
        return F.struct(
            t["x"].alias("x"), F.substring(mantissa, 1, digits).cast("bigint").alias("head"), F.substring(mantissa, digits + 1, 17).cast("bigint").alias("rest"), F.substring_index(t["t"], "e", -1).cast("int").alias("e")
        )

    def choose(p: Column) -> Column:
        hard = (F.abs(p["rest"] - half) <= 100) | (F.abs(p["x"]) < _SMALLEST_NORMAL)
        easy = F.struct((p["head"] + F.when(p["rest"] > half, 1).otherwise(0)).alias("n"), p["e"].alias("e"))
        return F.struct(p["x"].alias("x"), F.when(hard, _exact(F.abs(p["x"]), digits)).otherwise(easy).alias("r"))

    def text(c: Column) -> Column:
        over = c["r"]["n"] >= 10**digits
        shown = F.when(over, F.lit(str(10 ** (digits - 1)))).otherwise(c["r"]["n"].cast("string"))
        return F.concat(F.when(c["x"] < 0, "-").otherwise(""), F.substring(shown, 1, 1), F.lit("."), F.substring(shown, 2, digits), F.lit("e"), (c["r"]["e"] + F.when(over, 1).otherwise(0)).cast("string"))

    return _let(F.struct(x.alias("x"), _scientific(x, 17).alias("t")), lambda t: _let(read(t), lambda p: _let(choose(p), text)))


def general_text(x: Column) -> Column:
    """A double to 12 significant digits without trailing zeros; plain from 1e-4 to 1e12."""
    nothing = F.when(x == 0, F.when(F.startswith(x.cast("string"), F.lit("-")), "-0").otherwise("0"))
    return F.when(x.isNotNull(), F.coalesce(_special(x, "nan", "inf"), nothing, _whole(x, 1e12, ""), _let(x, lambda v: _laid_out(_rounded(v, 12), 12, ""))))


#: Decimal digits of all scripts beside ASCII's, and theirs.
_DIGITS = "".join(chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) is not None)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def ascii_digits(x: Column) -> Column:
    """Digits of any script as ASCII ones, which casts need."""
    return F.when(x.rlike(r"\A[\x00-\x7F]*\z"), x).otherwise(F.translate(x, _DIGITS, _ASCII_DIGITS))


def json_text(x: Column, kind: str) -> Column:
    """A value inside a compact JSON array."""
    if kind == "double":
        found = float_text(x)
    elif kind in ("int", "bigint"):
        found = x.cast("string")
    else:
        quoted = F.to_json(F.struct(x.alias("v")))
        found = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    return F.when(x.isNull(), "null").otherwise(found)


def json_hash(*parts: tuple[Column, str]) -> Column:
    """SHA-256 of the parts as a JSON array. Neighbouring texts are written as one array, without its brackets: no text's JSON begins or ends with one."""
    pieces, texts = [], []
    for x, kind in (*parts, (None, "end")):
        if kind == "string":
            texts.append(x)
            continue
        if texts:
            pieces.append(F.rtrim(F.ltrim(F.to_json(F.array(*texts)), F.lit("[")), F.lit("]")))
            texts = []
        if x is not None:
            pieces.append(json_text(x, kind))
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *pieces), F.lit("]")), 256)


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole to two places, rounded half to even on the binary value; 0 of nothing."""
    share = _formatted(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), "0.00").cast("double")
    return F.coalesce(share, F.lit(0.0))


_WEEK = r"\A(\d{4})(-?)W(\d{2})(?:\2([1-7]))?\z"


def iso_date(x: Column) -> Column:
    """The date that text begins with, within ten characters, in an ISO form: by day, compact or by week; else null."""
    head = F.substring(x, 1, 10)
    forms = [F.try_to_date(F.when(head.rlike(form), head), p) for form, p in ((r"\A\d{4}-\d{2}-\d{2}\z", "yyyy-MM-dd"), (r"\A\d{8}\z", "yyyyMMdd"))]
    year, week, day = (F.regexp_extract(head, _WEEK, k).try_cast("int") for k in (1, 3, 4))
    fourth = F.make_date(F.when(head.rlike(_WEEK) & (year > 0), year), F.lit(1), F.lit(4))  # always in the first week
    first = F.date_add(F.date_sub(fourth, F.weekday(fourth)), 7 * (week - 1))
    within = (week > 0) & (F.year(F.date_add(first, F.lit(3))) == year)  # a week is its Thursday's year's
    return F.coalesce(*forms, F.when(within, F.date_add(first, F.coalesce(day, F.lit(1)) - 1)))


def power(x: Column) -> Column:
    """A registry number: a comma or point before decimals, spaces anywhere; else null."""
    text = ascii_digits(F.replace(fold(nfkc(x)), F.lit(" "), F.lit("")))
    return F.when(text.rlike(r"(?U)\A[-+]?\d+(?:\.\d+)?\z"), text.try_cast("double"))


def registry_date(x: Column) -> Column:
    """Day-month-year with or without a time, or an ISO date, as an ISO date; other text stays as it is."""
    text = fold(nfkc(x))
    day = r"\d{1,2}-\d{1,2}-\d{4}"
    forms = (
        (rf"\A{day} \d{{1,2}}:\d{{1,2}}:\d{{1,2}}\z", "d-M-yyyy H:m:s"),
        (rf"\A{day}\z", "d-M-yyyy"),
        (r"\A\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    )
    parsed = [F.date_format(F.try_to_timestamp(F.when(text.rlike(form), text), F.lit(p)), "yyyy-MM-dd") for form, p in forms]
    return F.coalesce(*parsed, filled(text))
