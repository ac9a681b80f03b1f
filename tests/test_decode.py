from __future__ import annotations

import pytest
from helpers import arrivals, lookup_frames, lookups, plan, rows
from pyspark.sql import functions as F

from arrivals_engine.operators import decode, joins
from arrivals_engine.operators.clean import clean_arrivals
from arrivals_engine.operators.quality import QualityError, measure_lookups

DECODED = ["port_city", "port_state_code", "dest_state_code", "dest_state_name", "origin_country"]


def decoded(spark, change, **options):
    frame = decode.decode(clean_arrivals(arrivals(spark, change)), lookups(spark, **options))
    return tuple(frame.select(*DECODED).first())


def test_hits(spark):
    assert decoded(spark, {}) == ("NEW YORK", "NY", "NY", "NEW YORK", "ALBANIA")


def test_misses_and_nulls_become_other(spark):
    other = ("Other",) * 5
    assert decoded(spark, {"i94port": "ZZZ", "i94addr": "ZZ", "i94cit": 999.0}) == other
    assert decoded(spark, {"i94port": None, "i94addr": None, "i94cit": None}) == other


def test_empty_lookup_cells_become_other(spark):
    assert decoded(spark, {"i94port": "XXX"})[:2] == ("Other", "Other")


def test_origin_codes_compare_as_numbers(spark):
    assert decoded(spark, {"i94cit": 102.0})[4] == "ANDORRA"


def test_codes_that_are_no_numbers_match_nothing(spark):
    codes = spark.createDataFrame([("XX",), ("01",), (" 1 ",), (None,)], "origin_code string")
    found = [r[0] for r in decode.int_origin_codes(codes).collect()]
    assert found == [None, 1, 1, None]


def test_lookup_keys_are_dropped(spark):
    frame = decode.decode(clean_arrivals(arrivals(spark, {})), lookups(spark))
    assert not {"port_code", "origin_code"} & set(frame.columns)
    assert frame.columns.count("dest_state_code") == 1


@pytest.mark.parametrize("which", [0, 1, 2])
def test_repeated_lookup_keys_are_refused(spark, which):
    frames = list(lookup_frames(spark))
    frames[which] = frames[which].union(frames[which].limit(1))
    with pytest.raises(QualityError, match="repeated lookup keys"):
        decode.checked_lookups(*frames)


def test_origin_codes_that_become_equal_are_refused(spark):
    ports, destinations, _ = lookup_frames(spark)
    origins = spark.createDataFrame(
        [("1", "A"), ("01", "B")], "origin_code string, origin_country string"
    )
    with pytest.raises(QualityError):
        decode.checked_lookups(ports, destinations, origins)


def test_unusable_lookup_keys_may_repeat(spark):
    ports, destinations, origins = lookup_frames(spark)
    empty = spark.createDataFrame([(None, "A", "B")] * 2, ports.schema)
    text = spark.createDataFrame([("N/A", "A"), ("n/a", "B")], origins.schema)
    decode.checked_lookups(ports.union(empty), destinations, origins.union(text))


def test_empty_lookups_give_other(spark):
    frames = [frame.limit(0) for frame in lookup_frames(spark)]
    frame = decode.decode(clean_arrivals(arrivals(spark, {})), decode.checked_lookups(*frames))
    assert tuple(frame.select(*DECODED).first()) == ("Other",) * 5


def test_measured_bytes_grow_with_the_lookup(spark):
    small = spark.range(10).selectExpr("CAST(id AS STRING) AS k", "repeat('x', 100) AS v")
    large = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "repeat('x', 100) AS v")
    stats = measure_lookups({"small": (small, "k"), "large": (large, "k")})
    assert stats["small"].surplus == stats["large"].surplus == 0
    assert 1000 < stats["small"].bytes < 3000
    assert stats["large"].bytes > 100 * 1000


def test_only_measured_small_lookups_are_broadcast(spark):
    cleaned = clean_arrivals(arrivals(spark, {}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(decode.decode(cleaned, lookups(spark)))
        large = plan(decode.decode(cleaned, lookups(spark, max_broadcast_bytes=0)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in small
    assert large.count("SortMergeJoin") == 3
    assert "Broadcast" not in large
    assert "Cartesian" not in large


def test_large_lookups_give_the_same(spark):
    many = clean_arrivals(
        arrivals(
            spark,
            *(
                {
                    "admnum": float(i),
                    "i94port": ("NYC", "SEA", "ZZZ", None)[i % 4],
                    "i94addr": ("NY", "QQ", None)[i % 3],
                    "i94cit": (101.0, 102.0, 5.0, None)[i % 4],
                }
                for i in range(200)
            ),
        )
    )
    broadcast = decode.decode(many, lookups(spark))
    merged = decode.decode(many, lookups(spark, max_broadcast_bytes=0))
    assert merged.columns == broadcast.columns
    assert rows(merged) == rows(broadcast)


def test_a_large_lookup_that_compresses_well_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "ports")
    many = spark.range(100_000).selectExpr(
        "concat('P', id) AS port_code", "repeat('x', 60) AS port_city", "'NY' AS port_state_code"
    )
    many.coalesce(1).write.parquet(path)
    ports = spark.read.parquet(path)
    assert measure_lookups({"p": (ports, "port_code")})["p"].bytes > 10 << 20
    hot = spark.range(1000).selectExpr("id", "concat('P', id % 3) AS i94port")
    joined = joins.lookup_join(hot, ports, "i94port", "port_code", small=False)
    assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
    assert "Generate" not in plan(joined)


def test_a_frequent_code_is_split_by_adaptive_execution(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    hot = spark.range(0, 100_000, numPartitions=8).selectExpr(
        "sha2(string(id), 256) AS h", "if(id % 100 > 0, 'NYC', concat('X', id)) AS i94port"
    )
    ports = lookup_frames(spark)[0]
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        joined = joins.lookup_join(hot, ports, "i94port", "port_code", small=False)
        parted = joined.groupBy(F.spark_partition_id())
        sizes = parted.agg(F.count("*").alias("count"), F.max("h")).collect()
        assert joined.filter("port_city = 'NEW YORK'").count() == 99_000
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert len(sizes) > 4
    assert max(r["count"] for r in sizes) < 50_000


def test_frequent_codes_are_dealt_out_evenly(spark):
    """A third of the rows has one code, a third none; no task has twice the mean."""
    code = "CASE id % 3 WHEN 0 THEN 'HOT' WHEN 1 THEN CAST(id % 500 AS STRING) END"
    rows_ = spark.range(60_000).selectExpr(f"{code} AS code", "id").repartition(4)
    lookup = spark.range(500).selectExpr("CAST(id AS STRING) AS known", "id AS value")
    lookup = lookup.union(spark.createDataFrame([("HOT", -1), ("OTHER", -2)], lookup.schema))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = joins.hot_codes(rows_, ["code"], 8)["code"]
        assert set(hot.parts) == {"HOT"} and hot.parts["HOT"] >= 20 and hot.parts_of_none >= 20
        found = joins.dealt_lookup_join(rows_, lookup, "code", "known", hot)
        plain = joins.lookup_join(rows_, lookup, "code", "known", False)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        uneven = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8 < max(uneven)
        assert rows(found) == rows(plain) and found.columns == plain.columns
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_frequent_codes_change_nothing(spark):
    port = ("NYC", "NYC", "NYC", None, "ZZZ")
    changes = [{"admnum": float(i), "i94port": port[i % 5], "i94cit": (101.0, None)[i % 2]} for i in range(300)]
    many = clean_arrivals(arrivals(spark, *changes))
    codes = lookups(spark, max_broadcast_bytes=0)
    hot = decode.hot_codes_of(many, codes)
    assert hot["i94port"].parts["NYC"] > 1 and hot["i94cit"].parts == {101: hot["i94cit"].parts[101]}
    assert rows(decode.decode(many, codes, hot)) == rows(decode.decode(many, lookups(spark)))
    assert decode.hot_codes_of(many, lookups(spark)) == {}
    none = decode.hot_codes_of(many.limit(0), codes)
    assert rows(decode.decode(many, codes, none)) == rows(decode.decode(many, codes, hot))
