"""Registry records rendered from the driver's tables, so that every operator runs on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlode.functions.schemas import RAW
from gridlode.sources.files import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _render(*parts: str) -> Column:
    return F.concat(*(F.col(p).cast("string") if p.startswith(("l_", "s_", "o_")) else F.lit(p) for p in parts))


def points() -> Column:
    """A connection point of one of five kinds, by line number."""
    kind = F.col("l_linenumber") % 5
    return (
        F.when(kind == 0, _render("РУ-10 кВ ПС 35/10 кВ №", "l_suppkey", " Вузол"))
        .when(kind == 1, _render("ПЛ-0,4 кВ КТП-", "l_suppkey", "-", "l_linenumber", " Л-2"))
        .when(kind == 2, _render("КЛ-0,4 кВ ЗТП-", "l_suppkey", " 10/0,4 кВ"))
        .when(kind == 3, _render("опора ", "l_suppkey", " біля дороги"))
        .otherwise(_render("ПС №", "l_suppkey", " Вузол КТП-", "l_suppkey"))
    )


#: The columns of lineitem that records are made of.
LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")


def records(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """A raw record for each line item, with its columns `keep` besides."""
    part, order, day = F.col("l_partkey"), F.col("l_orderkey"), F.date_format("l_shipdate", "yyyy-MM-dd")
    kind = F.col("l_linenumber") % 5
    columns = {
        "source": F.lit("tpch"),
        "source_url": F.lit("http://registry.example/"),
        "source_page": part,
        "source_row_index": F.col("l_linenumber"),
        "fetched_at": F.lit("2002-01-01 00:00:00"),
        "tu_number": F.when(order % 50 == 0, None).when(order % 50 == 1, "").otherwise(order.cast("string")),
        "tu_date": F.when(part % 19 == 0, "Дані відсутні").otherwise(day),
        "installation_type": F.when(part % 13 == 0, None).when(part % 11 == 0, "генерація та споживання")
        .when(F.col("l_returnflag") == "N", "генерація").when(F.col("l_returnflag") == "A", "споживання").otherwise("УЗЕ"),
        "connection_point_raw": points(),
        "voltage_raw": F.when(part % 7 == 0, "6").when(kind.isin(1, 2), "0,4").otherwise("10"),
        "requested_power_kw": F.when(part % 17 != 0, F.col("l_quantity") * 100),
        "connection_type": F.col("l_linestatus"),
        "rem": F.col("l_returnflag"),
        "contract_number": F.concat(F.lit("D-"), part),
        "contract_date": F.lit(None),
        "commissioning_stages": F.lit(None),
        "payment_date": day,
    }
    kinds = dict(c.split() for c in RAW.split(", "))
    return spread(table(spark, sf_dir, "lineitem").select(*LINE)).select(*keep, *(columns[c].cast(k).alias(c) for c, k in kinds.items()))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridlode.operators.identity import with_identities
    from gridlode.operators.points import parse_records

    return parse_records(with_identities(records(spark, sf_dir)))


def observed(spark: SparkSession, sf_dir: str, first_run: bool = False) -> DataFrame:
    """Records of a small registry, one for each customer, three of which share a number: the second has another
    contract and page, the third is a copy of the first or has more power. In the first run the third is missing."""
    key, n, j = F.col("c_custkey"), F.floor(F.col("c_custkey") / 3).cast("bigint"), F.col("c_custkey") % 3
    text = lambda *parts: F.concat(*(p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts))
    node = n % 97
    kind = n % 5
    point = (
        F.when(kind == 0, text("РУ-10 кВ ПС 35/10 кВ №", node, " Вузол")).when(kind == 1, text("ПЛ-0,4 кВ КТП-", node, "-1 Л-2"))
        .when(kind == 2, text("КЛ-0,4 кВ ЗТП-", node, " 10/0,4 кВ")).when(kind == 3, text("опора ", node, " біля дороги")).otherwise(text("ПС №", node, " Вузол КТП-", node))
    )
    columns = {
        "source": F.lit("reg"),
        "source_url": F.lit("http://registry.example/"),
        "source_page": key,
        "source_row_index": F.lit(1),
        "fetched_at": F.lit("2001-12-01 00:00:00" if first_run else "2001-12-31 00:00:00"),
        "tu_number": text("T", n),
        "tu_date": text("2001-", F.lpad((n % 12 + 1).cast("string"), 2, "0"), "-15"),
        "installation_type": F.element_at(F.array(*map(F.lit, ("генерація", "споживання", "УЗЕ", "інше"))), (n % 4 + 1).cast("int")),
        "connection_point_raw": point,
        "voltage_raw": F.when(kind.isin(1, 2), "0,4").otherwise("10"),
        "requested_power_kw": F.when(n % 9 != 0, (n % 50) * 10.25 + F.when((j == 2) & (n % 2 == 0), 100.125).otherwise(0.0)),
        "connection_type": F.lit("c"),
        "rem": F.lit("r"),
        "contract_number": F.when(j == 1, text("D-", n, "-x")).otherwise(text("D-", n)),
        "contract_date": F.lit(None),
        "commissioning_stages": F.lit(None),
        "payment_date": F.lit(None),
    }
    kinds = dict(c.split() for c in RAW.split(", "))
    rows = table(spark, sf_dir, "customer")
    return (rows.where("c_custkey % 3 < 2") if first_run else rows).select(*(columns[c].cast(k).alias(c) for c, k in kinds.items()))


#: The small registry in SQL, from the base columns alone.
OBSERVED_SQL = """
sb AS (SELECT c_custkey AS source_page, c_custkey // 3 AS n, c_custkey % 3 AS j FROM customer),
sr AS (SELECT *, n % 5 AS kind, n % 97 AS node, 'reg' AS source, 1 AS source_row_index, 'T' || n AS tu_number, '2001-' || lpad(CAST(n % 12 + 1 AS VARCHAR), 2, '0') || '-15' AS tu_date,
  ['генерація', 'споживання', 'УЗЕ', 'інше'][n % 4 + 1] AS installation_type, ['generation', 'consumption', 'bess', 'unknown'][n % 4 + 1] AS activity_type,
  CASE WHEN n % 9 <> 0 THEN (n % 50) * 10.25::DOUBLE + CASE WHEN j = 2 AND n % 2 = 0 THEN 100.125::DOUBLE ELSE 0 END END AS requested_power_kw,
  'D-' || n || CASE WHEN j = 1 THEN '-x' ELSE '' END AS contract_number FROM sb),
st AS (SELECT *, CASE WHEN kind IN (1, 2) THEN '0,4' ELSE '10' END AS voltage_raw, coalesce(CAST(requested_power_kw AS VARCHAR), 'null') AS power_json,
  CASE kind WHEN 0 THEN 'РУ-10 кВ ПС 35/10 кВ №' || node || ' Вузол' WHEN 1 THEN 'ПЛ-0,4 кВ КТП-' || node || '-1 Л-2' WHEN 2 THEN 'КЛ-0,4 кВ ЗТП-' || node || ' 10/0,4 кВ'
    WHEN 3 THEN 'опора ' || node || ' біля дороги' ELSE 'ПС №' || node || ' Вузол КТП-' || node END AS connection_point_raw,
  CASE kind WHEN 0 THEN 'PS-' || node || '-VUZOL' WHEN 1 THEN 'KTP-' || node || '-1' WHEN 2 THEN 'ZTP-' || node WHEN 4 THEN 'PS-' || node || '-VUZOL' END AS canonical_node_id,
  CASE kind WHEN 3 THEN 0.0 WHEN 4 THEN 0.6 WHEN 1 THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence, kind > 2 AS needs_review,
  CASE kind WHEN 3 THEN 'unknown_object_type' WHEN 4 THEN 'multiple_parent_candidates' ELSE '' END AS flags,
  CASE kind WHEN 0 THEN 'PS' WHEN 1 THEN 'KTP' WHEN 2 THEN 'ZTP' WHEN 4 THEN 'PS' END AS parent_object_type FROM sr),
so AS (SELECT *,
  sha256(concat_ws(chr(31), source, tu_number, tu_date, connection_point_raw, coalesce(printf('%.12g', requested_power_kw), ''))) AS record_key,
  sha256('["reg","' || tu_number || '","' || tu_date || '","' || contract_number || '",null,"' || installation_type || '",null,"' || connection_point_raw || '","' || voltage_raw || '",'
    || power_json || ',"c","r",null]') AS row_fingerprint,
  sha256('["reg","' || tu_number || '"]') AS logical_tu_key,
  sha256('["reg",2,' || source_page || ',1]') AS observation_key FROM st)
"""

#: The same records in SQL, from the base columns alone: no text is parsed.
SQL = """
base AS (SELECT *, l_linenumber % 5 AS kind, l_partkey % 7 = 0 AND l_linenumber % 5 < 3 AS conflict,
  CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d FROM lineitem),
rec AS (SELECT *, 'tpch' AS source, l_partkey AS source_page, l_linenumber AS source_row_index,
  CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey % 50 = 1 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS tu_number,
  coalesce(CAST(d AS VARCHAR), 'Дані відсутні') AS tu_date,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 11 = 0 THEN 'генерація та споживання' WHEN l_returnflag = 'N' THEN 'генерація'
       WHEN l_returnflag = 'A' THEN 'споживання' ELSE 'УЗЕ' END AS installation_type,
  CASE WHEN l_partkey % 13 = 0 THEN 'unknown' WHEN l_partkey % 11 = 0 THEN 'mixed' WHEN l_returnflag = 'N' THEN 'generation'
       WHEN l_returnflag = 'A' THEN 'consumption' ELSE 'bess' END AS activity_type,
  CASE WHEN l_partkey % 13 = 0 OR l_partkey % 11 = 0 THEN 'other' WHEN l_returnflag = 'N' THEN 'generation'
       WHEN l_returnflag = 'A' THEN 'load' ELSE 'bess' END AS fam,
  CASE kind WHEN 0 THEN 'РУ-10 кВ ПС 35/10 кВ №' || l_suppkey || ' Вузол' WHEN 1 THEN 'ПЛ-0,4 кВ КТП-' || l_suppkey || '-' || l_linenumber || ' Л-2'
       WHEN 2 THEN 'КЛ-0,4 кВ ЗТП-' || l_suppkey || ' 10/0,4 кВ' WHEN 3 THEN 'опора ' || l_suppkey || ' біля дороги'
       ELSE 'ПС №' || l_suppkey || ' Вузол КТП-' || l_suppkey END AS connection_point_raw,
  CASE WHEN l_partkey % 7 = 0 THEN '6' WHEN kind IN (1, 2) THEN '0,4' ELSE '10' END AS voltage_raw,
  CASE WHEN l_partkey % 17 <> 0 THEN l_quantity * 100 END AS requested_power_kw,
  l_linestatus AS connection_type, l_returnflag AS rem, 'D-' || l_partkey AS contract_number, strftime(l_shipdate, '%Y-%m-%d') AS payment_date,
  CASE kind WHEN 0 THEN 'PS-' || l_suppkey || '-VUZOL' WHEN 1 THEN 'KTP-' || l_suppkey || '-' || l_linenumber WHEN 2 THEN 'ZTP-' || l_suppkey
       WHEN 3 THEN NULL ELSE 'PS-' || l_suppkey || '-VUZOL' END AS canonical_node_id,
  CASE WHEN kind = 3 THEN 0.0 WHEN kind = 4 OR conflict THEN 0.6 WHEN kind = 1 THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence,
  kind > 2 OR conflict AS needs_review,
  list_filter([CASE kind WHEN 3 THEN 'unknown_object_type' WHEN 4 THEN 'multiple_parent_candidates' END,
    CASE WHEN conflict THEN 'conflicting_voltage_context' END], lambda x: x IS NOT NULL) AS flags,
  CASE kind WHEN 0 THEN 'RU' WHEN 1 THEN 'PL' WHEN 2 THEN 'KL' WHEN 3 THEN 'UNKNOWN' ELSE 'PS' END AS family,
  CASE kind WHEN 0 THEN 'РУ-{N} КВ ПС {N}/{N} КВ №{N} ВУЗОЛ' WHEN 1 THEN 'ПЛ-{N} КВ КТП-{N}-{N} Л-{N}' WHEN 2 THEN 'КЛ-{N} КВ ЗТП-{N} {N}/{N} КВ'
       WHEN 3 THEN 'ОПОРА {N} БІЛЯ ДОРОГИ' ELSE 'ПС №{N} ВУЗОЛ КТП-{N}' END AS pattern
  FROM base),
tu AS (SELECT *,
  sha256(concat_ws(chr(31), source, coalesce(tu_number, ''), tu_date, connection_point_raw, coalesce(CAST(CAST(requested_power_kw AS BIGINT) AS VARCHAR), ''))) AS record_key,
  sha256('[' || concat_ws(',', '"tpch"', coalesce('"' || tu_number || '"', 'null'), '"' || tu_date || '"', '"' || contract_number || '"', 'null',
    coalesce('"' || installation_type || '"', 'null'), 'null', '"' || connection_point_raw || '"', '"' || voltage_raw || '"',
    coalesce(CAST(requested_power_kw AS VARCHAR), 'null'), '"' || connection_type || '"', '"' || rem || '"', '"' || payment_date || '"') || ']') AS row_fingerprint,
  sha256(CASE WHEN tu_number <> '' THEN '["tpch","' || tu_number || '"]'
    ELSE '["tpch","' || tu_date || '","' || contract_number || '","' || connection_point_raw || '",' || coalesce(CAST(requested_power_kw AS VARCHAR), 'null') || ']' END) AS logical_tu_key
  FROM rec)
"""
