"""Connection points: free text to a canonical node, in Column expressions.

Every object token gets marks before and after it; splitting at the first mark
gives each token with the text up to the next token. Type and place alone
choose the parent, so only the chosen stretch is read further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from gridlode.functions.schemas import PARSED_FIELDS, POINT, POINT_FIELDS
from gridlode.functions.text import LETTER, activity, filled, normalize, slug_stable
from gridlode.functions.values import ascii_digits
from gridlode.sources.files import written

# Parent tokens by rank of their type, and connection tokens.
PARENTS = (("ПС", "PS", 0), ("ЦРП", "CRP", 1), ("РП", "RP", 2), ("КТПП", "KTP", 3), ("СКТП", "KTP", 3), ("КТП", "KTP", 3), ("ЗТП", "ZTP", 4), ("ЩТП", "TP", 5), ("ТП", "TP", 5))
CONNECTIONS = (("РУ", "RU"), ("ПЛІ", "PL"), ("ПЛ", "PL"), ("КЛ", "KL"))

TEXTS_MB = 64

_TOKEN = f"(?iu)(?<![{LETTER}])({'|'.join(t for t, *_ in (*PARENTS, *CONNECTIONS))})(?![{LETTER}])"
_VOLT = r"\d+(?:\.\d+)?"
_VOLTS = rf"(?iuU)\A({_VOLT}(?:\s*/\s*{_VOLT})+|{_VOLT})\s*кВ"
_ID = rf"\d+(?:-[{LETTER}0-9]+)*"
_SIGNED = rf"(?iuU)\A(?:№\s*|-\s*)({_ID})"
_PLAIN = rf"(?iuU)\A(?:-|№)?\s*({_ID})"
_BARE = rf"(?iuU)\A({_ID})\b"
_CUT = r"(?iusU)(?:^|\s+)(?:(?:Л|L)\s*-\s*\d|фідер\b).*\z"


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once and named, so that no rule of the optimizer copies it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _take(text: Column, pattern: str, when: Column) -> Column:
    """struct(found, rest): the first group and the text after the match; nothing is taken unless `when`."""
    found = filled(F.regexp_extract(text, pattern, 1))
    rest = F.when(when & found.isNotNull(), F.trim(F.regexp_replace(text, pattern, ""))).otherwise(text)
    return F.struct(F.when(when, found).alias("found"), rest.alias("rest"))


def _by_token(token: Column, at: int) -> Column:
    return F.element_at(F.create_map(*(F.lit(v) for p in PARENTS for v in (p[0], p[at]))), token)


def _parents(text: Column) -> Column:
    """The parent tokens in a text: struct(rank, place, code, rest)."""
    pieces = F.split(F.regexp_replace(text, _TOKEN, "\u0001$1\u0002"), "\u0001")
    stretches = F.transform(
        F.filter(pieces, lambda p: F.contains(p, F.lit("\u0002"))),
        lambda p, i: F.struct(F.upper(F.substring_index(p, "\u0002", 1)).alias("token"), F.trim(F.substring_index(p, "\u0002", -1)).alias("rest"), i.alias("place")),
    )
    parents = F.filter(stretches, lambda s: s["token"].isin(*(p[0] for p in PARENTS)))
    return F.transform(parents, lambda s: F.struct(_by_token(s["token"], 2).alias("rank"), s["place"].alias("place"), _by_token(s["token"], 1).alias("code"), s["rest"].alias("rest")))


def _fields(text: Column, parents: Column, code: Column, number: Column, name: Column, volts: Column) -> Column:
    connection = voltage = F.lit(None).cast("string")
    for token, kind in reversed(CONNECTIONS):
        found = filled(F.regexp_extract(text, rf"(?iuU)(?<![{LETTER}]){token}\s*-?\s*({_VOLT})\s*кВ", 1))
        connection, voltage = F.when(found.isNotNull(), kind).otherwise(connection), F.coalesce(found, voltage)
    line = filled(F.regexp_extract(text, rf"(?iuU)(?<![{LETTER}0-9])(?:Л|L)\s*-\s*(\d+[{LETTER}0-9-]*)", 1))
    named = filled(F.regexp_extract(text, rf"(?iuU)фідер\s*№?\s*([{LETTER}0-9-]+)", 1))
    feeder = F.when(line.isNotNull(), F.upper(F.concat(F.lit("L-"), line))).when(named.isNotNull(), F.concat(F.lit("FEEDER-"), slug_stable(named)))

    none, many = code.isNull(), F.size(parents) > 1
    wide = code.isin("PS", "CRP", "RP") | number.isNull()
    tail = F.concat_ws("-", filled(slug_stable(number)), F.when(wide, filled(slug_stable(name))))
    sure = F.when(number.isNotNull(), F.when(volts.isNotNull(), 1.0).otherwise(0.90)).when(name.isNotNull(), 0.75).otherwise(0.50)
    sure = F.when(none, 0.0).when(many, F.least(sure, F.lit(0.60))).otherwise(sure)
    flags = F.when(none, F.array(F.lit("unknown_object_type"))).otherwise(
        F.array_compact(F.array(F.when(many, "multiple_parent_candidates"), F.when(number.isNull(), "missing_parent_identifier")))
    )
    levels = F.transform(F.split(ascii_digits(volts), "/"), lambda v: F.trim(v).cast("double"))
    return F.struct(
        connection.alias("connection_object_type"),
        ascii_digits(voltage).cast("double").alias("connection_voltage_kv"),
        F.lit(None).cast("string").alias("connection_object_number"),
        F.lit(None).cast("string").alias("connection_object_name"),
        feeder.alias("feeder_id"),
        code.alias("parent_object_type"),
        number.alias("parent_number"),
        name.alias("parent_name"),
        F.coalesce(levels, F.array().cast("array<double>")).alias("parent_voltage_levels_kv"),
        F.when(~none & (tail != ""), F.concat_ws("-", code, tail)).alias("canonical_node_id"),
        sure.alias("confidence"),
        (sure < 0.75).alias("needs_review"),
        flags.alias("flags"),
    )


def _parse(text: Column, parents: Column) -> Column:
    """The steps in which the chosen stretch is read, each on what the step before has left."""
    always = F.lit(True)

    def read(p: Column) -> Column:
        code = p["code"]
        boxed = code.isin("KTP", "ZTP")

        def last(v1: Column, n1: Column, n2: Column, v2: Column) -> Column:
            none_yet = F.coalesce(n1["found"], n2["found"]).isNull()
            bare = _take(v2["rest"], _BARE, none_yet & ~boxed & ~v2["rest"].rlike(rf"(?iuU)\A{_VOLT}\s*кВ"))
            return _let(bare, lambda n3: _fields(
                text, parents, code, F.coalesce(n1["found"], n2["found"], n3["found"]),
                filled(F.trim(F.regexp_replace(n3["rest"], _CUT, ""), F.lit(" ,-;"))), F.coalesce(v1["found"], v2["found"]),
            ))

        return _let(_take(p["rest"], _VOLTS, always), lambda v1:
               _let(_take(v1["rest"], _SIGNED, always), lambda n1:
               _let(_take(n1["rest"], _PLAIN, n1["found"].isNull() & boxed), lambda n2:
               _let(_take(n2["rest"], _VOLTS, v1["found"].isNull()), lambda v2: last(v1, n1, n2, v2)))))

    return _let(F.array_min(parents), read)


def parse_points(df: DataFrame, column: str = "connection_point_raw") -> DataFrame:
    """df with the 13 parsed fields of the text in a column."""
    text = F.translate(normalize(F.col(column)), "\u0001\u0002", "  ")
    # the text gets a column of its own: its NFKC form comes from Python, which no lambda can hold
    marked = df.withColumn("_text", text)
    parsed = _let(F.col("_text"), lambda t: _let(_parents(t), lambda parents: _parse(t, parents)))
    return marked.select(*df.columns, parsed.alias("_parsed")).select(*df.columns, "_parsed.*")


def published_voltage(x: Column) -> Column:
    """The number in a voltage field, if all of it is one."""
    text = normalize(x)
    return F.when(text.rlike(r"\A[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\z"), text.try_cast("double"))


def with_points(raw: DataFrame) -> DataFrame:
    """Raw records with the parsed fields of their points. Each different text is parsed once and written; records join it by their text.

    Parsing costs some hundred times what a join's row does, and registries
    repeat their texts. Texts of TEXTS_MB at most go to all executors, so that no
    record is dealt out for its text. Beyond that, both sides of the join are plain
    tables, so it deals the rows of a hot text, such as the empty one, out again.
    """
    text = F.coalesce("connection_point_raw", F.lit(""))
    texts = written(parse_points(raw.select(text.alias("_point")).distinct(), "_point"))
    size = texts.agg(F.sum(F.octet_length("_point") + 64)).first()[0] or 0  # 64 bytes for the fields beside a text
    if size <= TEXTS_MB << 20:
        texts = F.broadcast(texts)
    return raw.withColumn("_point", text).join(texts, "_point").drop("_point")


def parse_records(raw: DataFrame) -> DataFrame:
    """Raw records to parsed ones."""
    return _finished(with_points(raw).withColumn("parse_error", F.lit(None).cast("string")))


def parse_records_with(raw: DataFrame, parse: Callable[[str], dict]) -> DataFrame:
    """Raw records parsed by a Python function of the text, which gives the point's fields by name.

    A record on which it fails is kept with the error's text, without a node and for review.
    """
    schema = StructType([*raw.schema.fields, *StructType.fromDDL(f"{POINT}, parse_error string").fields])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[len(raw.columns) :]]
    at = raw.columns.index("connection_point_raw")

    def one(text: str | None) -> dict:
        try:
            return dict(parse(text or "")) | {"parse_error": None}
        except Exception as e:
            return {"confidence": 0.0, "needs_review": True, "flags": ["parse_error"], "parse_error": str(e), "parent_voltage_levels_kv": []}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(t) for t in batch.column(at).to_pylist()]
            more = [pa.array([g.get(n) for g in got], kind) for n, kind in zip((*POINT_FIELDS, "parse_error"), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return _finished(raw.mapInArrow(run, schema))


def _finished(df: DataFrame) -> DataFrame:
    apart = F.abs(published_voltage(F.col("voltage_raw")) - F.col("connection_voltage_kv")) > 1e-9
    df = df.withColumn("_apart", F.coalesce(apart, F.lit(False)) & F.col("parse_error").isNull())
    df = df.withColumn("flags", F.when(F.col("_apart"), F.array_append("flags", F.lit("conflicting_voltage_context"))).otherwise(F.col("flags")))
    df = df.withColumn("confidence", F.when(F.col("_apart"), F.least("confidence", F.lit(0.60))).otherwise(F.col("confidence")))
    df = df.withColumn("needs_review", F.col("needs_review") | F.col("_apart")).drop("_apart")
    df = df.withColumn("activity_type", activity(F.col("installation_type")))
    extra = [c for c in df.columns if c not in PARSED_FIELDS]
    return df.select(*PARSED_FIELDS, *extra)
