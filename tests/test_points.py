"""Golden vectors of the connection-point parser."""

import pytest

from gridlode.operators.points import parse_points, parse_records

# Connection points and what they must give.
VECTORS = [
    ("РУ-10 кВ ПС 35/10 кВ №144 Страдч", {"connection_object_type": "RU", "connection_voltage_kv": 10.0, "parent_object_type": "PS", "parent_number": "144", "parent_name": "Страдч", "parent_voltage_levels_kv": [35.0, 10.0], "canonical_node_id": "PS-144-STRADCH", "confidence": 1.0, "needs_review": False}),
    ("РУ-6 кВ ПС 110/10/6 кВ №249 Львів-10", {"connection_voltage_kv": 6.0, "parent_voltage_levels_kv": [110.0, 10.0, 6.0], "canonical_node_id": "PS-249-LVIV-10"}),
    ("ПЛ-0,4 кВ КТП-208-11 Л-2", {"connection_object_type": "PL", "connection_voltage_kv": 0.4, "parent_object_type": "KTP", "parent_number": "208-11", "canonical_node_id": "KTP-208-11", "feeder_id": "L-2"}),
    ("ПС №144 Страдч", {"canonical_node_id": "PS-144-STRADCH"}),
    ("ПС 35/10 кВ Страдч", {"parent_number": None, "parent_name": "Страдч", "canonical_node_id": "PS-STRADCH", "confidence": 0.75, "needs_review": False, "flags": ["missing_parent_identifier"]}),
    ("ПС №144 Страдч КТП-208-11", {"confidence": 0.6, "needs_review": True, "flags": ["multiple_parent_candidates"]}),
    ("ЗТП-17 10/0,4 кВ", {"parent_object_type": "ZTP", "parent_number": "17", "canonical_node_id": "ZTP-17"}),
    ("ТП №55", {"parent_object_type": "TP", "parent_number": "55", "canonical_node_id": "TP-55"}),
    ("  РУ–10 кВ   ПС 35/10 кВ N 144   Страдч ", {"connection_voltage_kv": 10.0, "canonical_node_id": "PS-144-STRADCH"}),
    ("точка приєднання біля дороги", {"canonical_node_id": None, "confidence": 0.0, "needs_review": True, "flags": ["unknown_object_type"]}),
    ("ПЛІ-0,4 кВ КТП-72-10 Л-2", {"connection_object_type": "PL", "connection_voltage_kv": 0.4, "canonical_node_id": "KTP-72-10"}),
    ("КЛ-0,4 кВ ЗТП-2258-КВ-19788 вул. Щирецька, 30/І", {"parent_number": "2258-КВ-19788", "canonical_node_id": "ZTP-2258-KV-19788"}),
    ("ПЛ-0,4 кВ КТПП-1140-22 Л-1 с.Ріпчичі 12", {"parent_object_type": "KTP", "canonical_node_id": "KTP-1140-22"}),
    ("СКТП-572-09 Зимна Вода", {"parent_object_type": "KTP", "canonical_node_id": "KTP-572-09"}),
    ("ПЛ-0,4 кВ ЩТП-37-42 Л-4 с.Горбків", {"parent_object_type": "TP", "canonical_node_id": "TP-37-42"}),
    ("РУ-0,4 кВ ЗТП-233-30 м.Моршин", {"canonical_node_id": "ZTP-233-30"}),
    ("ПС №1 А ПС №1 А", {"confidence": 0.6, "flags": ["multiple_parent_candidates"]}),
    ("ПЛ-10 кВ 201-37 Чишки", {"canonical_node_id": None, "needs_review": True}),
    ("", {"canonical_node_id": None, "flags": ["unknown_object_type"]}),
    # of our own
    ("ЦРП 12 Завод", {"parent_object_type": "CRP", "parent_number": "12", "canonical_node_id": "CRP-12-ZAVOD", "confidence": 0.9}),
    ("РП №3 Північ КТП-5", {"canonical_node_id": "RP-3-PIVNICH", "confidence": 0.6, "flags": ["multiple_parent_candidates"]}),
    ("КТП-1 фідер №Північ-4", {"canonical_node_id": "KTP-1", "feeder_id": "FEEDER-NOPIVNICH-4"}),
    ("ТП №5 ٣٥ кВ", {"canonical_node_id": "TP-5", "parent_voltage_levels_kv": [35.0]}),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(VECTORS)], "n int, connection_point_raw string")
    return {r["n"]: r.asDict() for r in parse_points(rows).collect()}


@pytest.mark.parametrize("n", range(len(VECTORS)))
def test_vector(found, n):
    assert {k: found[n][k] for k in VECTORS[n][1]} == VECTORS[n][1]


def test_published_voltage_that_differs_asks_for_review(spark):
    from gridlode.functions.schemas import RAW

    row = ["s", "u", 1, 1, None, "1", "2026-01-01", "генерація", "РУ-10 кВ ПС 35/10 кВ №144 Страдч", "6", 1.0, "c", "r", None, None, None, None]
    same = list(row)
    same[9] = "10,0"
    by_volt = {r["voltage_raw"]: r for r in parse_records(spark.createDataFrame([row, same], RAW)).collect()}
    assert by_volt["6"]["flags"] == ["conflicting_voltage_context"] and by_volt["6"]["confidence"] == 0.6 and by_volt["6"]["needs_review"]
    assert by_volt["10,0"]["flags"] == [] and by_volt["10,0"]["confidence"] == 1.0 and by_volt["6"]["activity_type"] == "generation"
