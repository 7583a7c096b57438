"""Registry text as Column expressions: normalization, slugs, classes of text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Text of these characters alone is its own NFKC form and never visits Python.
_STABLE = r"\A[\x00-\x7FÀ-ÿЁ-џҐґ]*\z"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def nfkc(x: Column) -> Column:
    stable = x.rlike(_STABLE)
    return F.coalesce(F.when(stable, x), _nfkc(F.when(~stable, x)))


def fold(x: Column) -> Column:
    """Normalization of text that is in NFKC form already: dashes, decimal commas, number signs, spaces."""
    x = F.translate(x, " ‐‑‒–—―−", " -------")
    x = F.regexp_replace(x, r"(?U)(?<=\d),(?=\d)", ".")
    x = F.regexp_replace(x, r"(?iU)\b(?:No\.?|N)\s*(?=\d)", "№")
    x = F.regexp_replace(x, r"(?U)№\s+", "№")
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def normalize(x: Column) -> Column:
    return fold(nfkc(F.coalesce(x, F.lit(""))))


# Transliteration of Cyrillic letters, one to many and, for translate() takes no more, one to one.
_MANY = {"Є": "IE", "Ж": "ZH", "Х": "KH", "Ц": "TS", "Ч": "CH", "Ш": "SH", "Щ": "SHCH", "Ь": "", "Ъ": "", "Ю": "IU", "Я": "IA"}
_ONE = ("АБВГҐДЕЗИІЇЙКЛМНОПРСТУФЫЭ", "ABVHGDEZYIIIKLMNOPRSTUFYE")
_LETTERS = "".join((*_MANY, _ONE[0]))


def slug_stable(x: Column) -> Column:
    """slug() of text that is in NFKC form already. Only letters of the map and ASCII count, whatever capitals others have."""
    x = F.translate(x, _LETTERS.lower(), _LETTERS)
    for letter, latin in _MANY.items():
        x = F.replace(x, F.lit(letter), F.lit(latin))
    x = F.regexp_replace(F.translate(x, *_ONE), "[^A-Za-z0-9]+", "-")
    return F.trim(F.upper(x), F.lit("-"))


def slug(x: Column) -> Column:
    return slug_stable(nfkc(F.coalesce(x, F.lit(""))))


def _any(x: Column, *parts: str) -> Column:
    found = F.contains(x, F.lit(parts[0]))
    for p in parts[1:]:
        found |= F.contains(x, F.lit(p))
    return found


def activity(x: Column) -> Column:
    """bess, mixed, generation, consumption or unknown."""
    low = F.lower(normalize(x))
    makes = _any(low, "генерац", "виробництв", "виробник")
    takes = _any(low, "споживан", "споживач", "навантажен")
    return (
        F.when(_any(low, "узе", "зберігання енергі", "накопичува"), "bess")
        .when(makes & takes, "mixed").when(makes, "generation").when(takes, "consumption").otherwise("unknown")
    )


def metric_family(activity_: Column) -> Column:
    return F.when(activity_ == "generation", "generation").when(activity_ == "consumption", "load").when(activity_ == "bess", "bess").otherwise("other")


LETTER = "А-ЯІЇЄҐA-Z"

# Families by their tokens, in the order in which they are tried.
FAMILIES = (
    ("PLI", "ПЛІ"),
    ("RU", "РУ"),
    ("PL", "ПЛ"),
    ("KL", "КЛ"),
    ("PS", "ПС"),
    ("KTP", "КТПП|СКТП|КТП"),
    ("ZTP", "ЗТП"),
    ("TP", "ЩТП|ТП"),
    ("CRP", "ЦРП"),
    ("RP", "РП"),
)


def connection_family(x: Column) -> Column:
    text, out = F.upper(normalize(x)), None
    for name, tokens in FAMILIES:
        found = text.rlike(rf"(?iuU)(?<![{LETTER}])(?:{tokens})(?=[-\s]|$)")
        out = F.when(found, name) if out is None else out.when(found, name)
    return out.otherwise("UNKNOWN")


def review_pattern(x: Column) -> Column:
    text = F.regexp_replace(F.upper(normalize(x)), r"(?U)\d+(?:[.,]\d+)?", "{N}")
    text = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("<EMPTY>"))


BUCKETS = ("high_0_90_1_00", "medium_0_75_0_89", "low_0_50_0_74", "critical_0_00_0_49")


def confidence_bucket(x: Column) -> Column:
    value = F.coalesce(x.try_cast("double"), F.lit(0.0))
    return F.when(value >= 0.90, BUCKETS[0]).when(value >= 0.75, BUCKETS[1]).when(value >= 0.50, BUCKETS[2]).otherwise(BUCKETS[3])


def flag_list(x: Column, kind: str = "array<string>") -> Column:
    """Flags as a list of texts: none for null, the empty text, 0 and false; one for any other single value."""
    if kind.startswith("array"):
        return F.coalesce(x.cast("array<string>"), F.array().cast("array<string>"))
    text = F.when(x, "True") if kind == "boolean" else F.when(x != 0, x.cast("string")) if kind != "string" else filled(x)
    return F.array_compact(F.array(text))


def filled(x: Column) -> Column:
    """null for the empty text."""
    return F.nullif(x, F.lit(""))
