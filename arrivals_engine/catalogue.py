"""Registered queries: each takes a session and a directory of test tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine import fixtures, schemas
from arrivals_engine.fixtures import Tables
from arrivals_engine.functions import categories, dates
from arrivals_engine.operators import clean, decode, quality
from arrivals_engine.plans import publish, reports, star
from arrivals_engine.sources import readers, tables
from arrivals_engine.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

LINEITEM = schemas.Table(
    "lineitem",
    (schemas.Column("l_orderkey", "BIGINT"), schemas.Column("l_linenumber", "INT")),
    key=("l_orderkey", "l_linenumber"),
)


def lookups(t: Tables) -> decode.Lookups:
    return decode.checked_lookups(fixtures.ports(t), fixtures.destinations(t), fixtures.origins(t))


def _cleaned(t: Tables) -> DataFrame:
    return clean.clean_arrivals(fixtures.raw_arrivals(t))


def _visits(t: Tables) -> DataFrame:
    return star.build_visits(fixtures.raw_arrivals(t), lookups(t))


def _fact(t: Tables) -> DataFrame:
    return star.visit_fact(_visits(t))


def _flat(t: Tables) -> DataFrame:
    return star.flatten_demographics(fixtures.raw_demographics(t))


def _totals(t: Tables) -> DataFrame:
    return star.narrow_totals(star.demographic_totals(_flat(t)))


def _races(t: Tables) -> DataFrame:
    return star.demographic_races(_flat(t))


def _decimals_as_double(rows: DataFrame) -> DataFrame:
    """For comparing results across engines, which print decimals differently."""
    return rows.withColumns(
        {name: F.col(name).cast("double") for name, kind in rows.dtypes if kind.startswith("decimal")}
    )


# ---- cleaning, decoding, deriving -----------------------------------------


def arrivals_typed_distinct(t: Tables) -> DataFrame:
    return clean.distinct_rows(clean.type_arrivals(fixtures.raw_arrivals(t)))


def arrivals_with_id(t: Tables) -> DataFrame:
    return clean.with_id(arrivals_typed_distinct(t))


def decode_port(t: Tables) -> DataFrame:
    rows = decode.fill_misses(decode.decode_port(_cleaned(t), lookups(t).ports))
    return rows.select("admnum", "i94port", "port_city", "port_state_code")


def decode_destination(t: Tables) -> DataFrame:
    rows = decode.fill_misses(decode.decode_destination(_cleaned(t), lookups(t).destinations))
    return rows.select("admnum", "i94addr", "dest_state_code", "dest_state_name")


def decode_origin(t: Tables) -> DataFrame:
    rows = decode.fill_misses(decode.decode_origin(_cleaned(t), lookups(t).origins))
    return rows.select("admnum", "i94cit", "origin_country")


def decode_large_lookups(t: Tables) -> DataFrame:
    """All lookups by the way for those that are too large to broadcast."""
    codes = decode.checked_lookups(
        fixtures.ports(t), fixtures.destinations(t), fixtures.origins(t), max_broadcast_bytes=0
    )
    return decode.decode(_cleaned(t), codes)


def decode_hot_codes(t: Tables) -> DataFrame:
    """The same with the frequent codes dealt out over tasks."""
    codes = decode.checked_lookups(
        fixtures.ports(t), fixtures.destinations(t), fixtures.origins(t), max_broadcast_bytes=0
    )
    hot = decode.hot_codes_of(clean.type_arrivals(fixtures.raw_arrivals(t)), codes)
    return decode.decode(_cleaned(t), codes, hot)


def derive_dates(t: Tables) -> DataFrame:
    return _cleaned(t).select(
        "admnum",
        dates.day_number_to_date(F.col("arrdate")).alias("arrival_date"),
        dates.day_number_to_date(F.col("depdate")).alias("departure_date"),
    )


def derive_year_month(t: Tables) -> DataFrame:
    parts = F.col("i94yr"), F.col("i94mon")
    return _cleaned(t).select(
        "admnum",
        dates.year_month(*parts).alias("year_month"),
        dates.year_month_text(*parts).alias("year_month_text"),
    )


def derive_categories(t: Tables) -> DataFrame:
    return _cleaned(t).select(
        F.col("admnum").alias("admission_id"),
        categories.entry_mode(F.col("i94mode")).alias("entry_mode"),
        categories.visa_category(F.col("i94visa")).alias("visa_category"),
    )


def derive_same_state_flag(t: Tables) -> DataFrame:
    return _visits(t).select(
        "admission_id", "dest_state_code", "port_state_code", "port_dest_equal_flag"
    )


# ---- reports --------------------------------------------------------------


def visits_by_month_gender(t: Tables) -> DataFrame:
    visits = _visits(t)
    return reports.visits_by_month_gender(
        star.visit_fact(visits), star.visitor_dim(visits), star.arrival_date_dim(visits)
    )


def port_diversity(t: Tables) -> DataFrame:
    return _decimals_as_double(reports.port_diversity(_fact(t), _totals(t), _races(t)))


# ---- quality --------------------------------------------------------------


def _star_report(t: Tables, check: str) -> DataFrame:
    visits = _visits(t)
    flat = _flat(t)
    return quality.batch_report(
        [
            (star.visit_fact(visits), schemas.VISITOR_ANALYSIS),
            (star.visitor_dim(visits), schemas.VISITORS),
            (star.arrival_date_dim(visits), schemas.ARRIVAL_DATE),
            (star.demographic_totals(flat), schemas.STATE_DEMOGRAPHICS),
            (star.demographic_races(flat), schemas.STATE_DEMOGRAPHICS_BY_RACE),
        ],
        (check,),
    )


def demographics_fit(t: Tables) -> DataFrame:
    """How many city measures their final column could not hold."""
    totals = star.demographic_totals(_flat(t))
    return quality.table_report(totals, schemas.STATE_DEMOGRAPHICS, ("fit",))


def gate_blocks_duplicates(t: Tables) -> DataFrame:
    report = quality.table_report(t.lineitem, LINEITEM)
    try:
        quality.gate(report)
    except quality.QualityError:
        return report.filter(~F.col("passed"))
    raise AssertionError("the gate let repeated keys through")


# ---- files ----------------------------------------------------------------


def _padded_csv(frame: DataFrame, path: str) -> None:
    """Text columns with blanks around them, which reading must take off."""
    padded = frame.select(
        *(F.concat(F.lit(" "), F.col(c), F.lit("  ")).alias(c) for c in frame.columns)
    )
    padded.write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def lookup_csv_roundtrip(t: Tables) -> DataFrame:
    """All visits decoded by lookups that were written to CSV and read back."""
    base = scratch_path(t.spark, "lookups")
    read = []
    for name, frame, columns in (
        ("ports", fixtures.ports(t), schemas.PORT_COLUMNS),
        ("destinations", fixtures.destinations(t), schemas.DESTINATION_COLUMNS),
        ("origins", fixtures.origins(t), schemas.ORIGIN_COLUMNS),
    ):
        _padded_csv(frame, f"{base}/{name}")
        read.append(readers.read_lookup(t.spark, f"{base}/{name}", columns))
    rows = decode.decode(_cleaned(t), decode.checked_lookups(*read))
    return rows.groupBy(
        "port_city", "port_state_code", "dest_state_code", "dest_state_name", "origin_country"
    ).agg(F.count(F.lit(1)).alias("visitor_cnt"))


def arrivals_csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "arrivals_csv")
    fixtures.raw_arrivals(t).write.csv(path, header=True)
    return star.build_visits(readers.read_arrivals(t.spark, path, "csv"), lookups(t))


def arrivals_parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "arrivals_parquet")
    fixtures.raw_arrivals(t).write.parquet(path)
    return star.build_visits(readers.read_arrivals(t.spark, path), lookups(t))


def fact_json_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "fact_json")
    tables.write_json(_fact(t), path)
    return readers.read_typed_json(t.spark, path, schemas.VISITOR_ANALYSIS)


def demographics_flat(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "demographics_json")
    tables.write_json(fixtures.raw_demographics(t), path)
    return star.flatten_demographics(readers.read_demographics(t.spark, path))


# ---- publishing -----------------------------------------------------------


def new_warehouse(spark: SparkSession, buckets: int | None = None) -> str:
    """A fresh database with empty tables, in the shared scratch folder."""
    db = f"arrivals_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    tables.create_tables(spark, db, buckets)
    return db


def publish_month_twice(t: Tables) -> DataFrame:
    """Replacing a month with itself changes nothing."""
    db = new_warehouse(t.spark)
    for _ in range(2):
        publish.publish_month(t.spark, db, fixtures.raw_arrivals(t), lookups(t))
    return t.spark.table(f"{db}.visitor_analysis").select(*schemas.VISITOR_ANALYSIS.names)


def publish_month_append(t: Tables) -> DataFrame:
    """Appending takes a batch once and refuses it the second time."""
    db = new_warehouse(t.spark)
    raw, codes = fixtures.raw_arrivals(t), lookups(t)
    publish.publish_month(t.spark, db, raw, codes, mode="append")
    try:
        publish.publish_batch(t.spark, db, publish.staged_batch(t.spark, db), mode="append")
    except quality.QualityError as refused:
        if "new_key" not in str(refused):
            raise
        return t.spark.table(f"{db}.visitors").select(*schemas.VISITORS.names)
    raise AssertionError("the gate let published keys through")


def publish_across_months(t: Tables) -> DataFrame:
    """How many keys are refused when all visits come once more as one month's."""
    db = _published(t)
    batch = publish.staged_batch(t.spark, db)
    moved = batch.fact.withColumn("year_month", F.lit(209912))
    index = t.spark.table(f"{db}.{schemas.VISIT_KEYS.name}")
    report = quality.collision_report(moved, index, schemas.VISITOR_ANALYSIS, other_months=True)
    try:
        publish.publish_batch(
            t.spark,
            db,
            publish.Batch(
                moved,
                batch.visitors.withColumn("year_month", F.lit(209912)),
                batch.arrival_date,
                same_keys=True,
            ),
        )
    except quality.QualityError as refused:
        if "new_key" not in str(refused):
            raise
        return report
    raise AssertionError("the gate let keys of other months through")


def _published(t: Tables) -> str:
    """A fresh database with everything published."""
    db = new_warehouse(t.spark)
    publish.publish_month(t.spark, db, fixtures.raw_arrivals(t), lookups(t))
    return db


def over_published(t: Tables, report: Callable[..., DataFrame], *names: str) -> DataFrame:
    """A report over published tables."""
    db = _published(t)
    if any("demographics" in name for name in names):
        flat = _flat(t)
        publish.refresh_demographics(
            t.spark, db, star.demographic_totals(flat), star.demographic_races(flat)
        )
    return report(*(t.spark.table(f"{db}.{name}") for name in names))


def tables_dropped(t: Tables) -> DataFrame:
    """How many rows each published table has, and how many tables of its name are left after
    all were dropped."""
    db = _published(t)
    flat = _flat(t)
    publish.refresh_demographics(
        t.spark, db, star.demographic_totals(flat), star.demographic_races(flat)
    )
    counts = [
        t.spark.table(f"{db}.{table.name}").agg(
            F.lit(table.name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for table in schemas.FINAL_TABLES + schemas.KEPT_TABLES
    ]
    path = scratch_path(t.spark, "table_counts")
    quality.union_all(counts).write.parquet(path)
    tables.drop_tables(t.spark, db)
    left = [row.tableName for row in t.spark.sql(f"SHOW TABLES IN {db}").collect()]
    is_left = F.col("table_name").isin(left).cast("long")
    return t.spark.read.parquet(path).withColumn("n_left", is_left)


def load_counts(t: Tables) -> DataFrame:
    """What became of arrivals that come as CSV text, as the load itself counts it."""
    path = scratch_path(t.spark, "arrivals_text")
    fixtures.raw_arrivals(t).write.csv(path, header=True)
    raw = readers.read_arrivals(t.spark, path, "csv", as_text=True)
    counts = publish.publish_month(t.spark, new_warehouse(t.spark), raw, lookups(t))
    return t.spark.createDataFrame(counts.lines(), "what string, n long")


def arrivals_layouts(t: Tables) -> DataFrame:
    """Columns that files of a folder lack, and how many records are in such files."""
    path = scratch_path(t.spark, "arrivals_layouts")
    raw = fixtures.raw_arrivals(t)
    raw.filter("i94mon <= 6").write.parquet(path)
    raw.filter("i94mon > 6").drop("gender", "i94visa").write.mode("append").parquet(path)
    try:
        readers.read_arrivals(t.spark, path)
    except ValueError as refused:
        if "['i94visa', 'gender']" not in str(refused):
            raise
        wanted = F.array(*(F.lit(name) for name, _, _ in schemas.ARRIVAL_COLUMNS))
        lacks = F.array_join(F.array_except(wanted, "columns"), ",")
        return readers.parquet_layouts(t.spark, path).select(lacks.alias("lacks"), "rows")
    raise AssertionError("a folder with incomplete files was read")


def dq_offending_keys(t: Tables) -> DataFrame:
    """The first keys that are not unique, as the report names them."""
    report = quality.table_report(t.lineitem, LINEITEM, ("row_count", "unique_key"), sample=5)
    return report.withColumn("keys", F.array_join("keys", ";"))


def dq_offending_dates(t: Tables) -> DataFrame:
    """Missing required values and the keys of their rows, in a batch without the defaults."""
    typed = clean.type_arrivals(fixtures.raw_arrivals(t)).select(
        F.col("admnum").alias("admission_id"),
        dates.day_number_to_date(F.col("arrdate")).alias("arrival_date"),
    )
    table = schemas.Table(
        "arrivals", tuple(schemas.Column(name, "", True) for name in schemas.VISIT_KEY), schemas.VISIT_KEY
    )
    report = quality.table_report(typed, table, ("unique_key", "required"), sample=3)
    return report.withColumn("keys", F.array_join("keys", ";"))


def published_less(t: Tables) -> DataFrame:
    """Dates left in the dimension after each month was replaced by its first half."""
    db = _published(t)
    batch = publish.stage_visits(t.spark, db, _visits(t).filter("day(arrival_date) <= 15"))
    publish.publish_batch(t.spark, db, batch)
    return t.spark.table(f"{db}.arrival_date")


def published_key_index(t: Tables) -> DataFrame:
    """The key index after a replace and an append, month by month."""
    return t.spark.table(f"{_published_in_parts(t)}.{schemas.VISIT_KEYS.name}")


def _published_in_parts(t: Tables) -> str:
    """Everything published, after a month's visits were replaced and others appended."""
    db = new_warehouse(t.spark)
    visits = _visits(t)
    for days, mode in (("> 15", "replace"), ("<= 15", "replace"), ("> 15", "append")):
        part = visits.filter(f"day(arrival_date) {days}")
        publish.publish_batch(t.spark, db, publish.stage_visits(t.spark, db, part), mode)
    return db


def kept_counts(t: Tables) -> DataFrame:
    """The kept counts, each month's added up."""
    counts = t.spark.table(f"{_published_in_parts(t)}.{schemas.MONTH_COUNTS.name}")
    keys = [c for c in counts.columns if c != reports.VISITS]
    return counts.groupBy(*keys).agg(F.sum(reports.VISITS).alias(reports.VISITS))


def kept_reports(t: Tables) -> DataFrame:
    """Reports over the kept counts, one below the other."""
    db = _published_in_parts(t)
    counts = t.spark.table(f"{db}.{schemas.MONTH_COUNTS.name}")
    totals = _totals(t)
    found = {
        "top_ports": (reports.top_ports(counts), "port_city"),
        "top_origins": (reports.top_origins(counts), "origin_country"),
        "visits_by_visa": (reports.visits_by_visa(counts), "visa_category"),
        "visits_by_month": (reports.visits_by_month(counts), "year_month"),
        "visits_by_mode": (reports.visits_by_mode(counts), "entry_mode"),
        "top_ports_population": (reports.top_ports_population(counts, totals), "port_city"),
    }
    return quality.union_all(
        [
            rows.select(
                F.lit(name).alias("report"),
                F.col(key).cast("string").alias("key"),
                F.col(reports.VISITS).alias(reports.VISITS),
            )
            for name, (rows, key) in found.items()
        ]
    )


def kept_port_diversity(t: Tables) -> DataFrame:
    counts = t.spark.table(f"{_published_in_parts(t)}.{schemas.MONTH_COUNTS.name}")
    return _decimals_as_double(reports.port_diversity(counts, _totals(t), _races(t)))


def staged_together(t: Tables) -> DataFrame:
    """Two batches in the stage at once; each publishes its own rows."""
    db = new_warehouse(t.spark)
    visits = _visits(t)
    halves = {"even": "year_month % 2 = 0", "odd": "year_month % 2 = 1"}
    staged = [publish.stage_visits(t.spark, db, visits.filter(f), name=n) for n, f in halves.items()]
    for batch in staged:
        publish.publish_batch(t.spark, db, batch)
    publish.release(t.spark, db, "odd")
    if publish.staged_names(t.spark, db) != ["even"]:
        raise AssertionError("a released batch is still staged")
    return t.spark.table(f"{db}.visitor_analysis").select(*schemas.VISITOR_ANALYSIS.names)


def published_dates(t: Tables) -> DataFrame:
    """Dates that several batches share are in the dimension once."""
    db = new_warehouse(t.spark)
    visits = _visits(t)
    for months in ("year_month % 2 = 0", "year_month % 2 = 1"):
        batch = publish.stage_visits(t.spark, db, visits.filter(months))
        publish.publish_batch(t.spark, db, batch)
    return t.spark.table(f"{db}.arrival_date")


def star_from_json(t: Tables) -> DataFrame:
    """Fact, visitors and dates handed over as JSON lines, then published."""
    db = new_warehouse(t.spark)
    batch = publish.stage_visits(t.spark, db, _visits(t))
    paths = publish.export_json(batch, scratch_path(t.spark, "star_json"))
    publish.publish_json(t.spark, db, *paths)
    return t.spark.table(f"{db}.visitors").select(*schemas.VISITORS.names)


def _demographics_from_json(t: Tables, table: schemas.Table) -> DataFrame:
    """Handed over as JSON lines and loaded back."""
    db = new_warehouse(t.spark)
    base = scratch_path(t.spark, "demographics_lines")
    tables.write_json(_totals(t), f"{base}/totals")
    tables.write_json(_races(t), f"{base}/races")
    publish.refresh_demographics_json(t.spark, db, f"{base}/totals", f"{base}/races")
    return _decimals_as_double(t.spark.table(f"{db}.{table.name}"))


def _refreshed_demographics(t: Tables, table: schemas.Table) -> DataFrame:
    db = new_warehouse(t.spark)
    flat = _flat(t)
    for _ in range(2):
        publish.refresh_demographics(
            t.spark, db, star.demographic_totals(flat), star.demographic_races(flat)
        )
    return _decimals_as_double(t.spark.table(f"{db}.{table.name}"))


# ---- catalogue ------------------------------------------------------------

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "arrivals_typed_distinct": arrivals_typed_distinct,
    "arrivals_distinct_by_digest": lambda t: clean.distinct_rows_by_digest(
        clean.type_arrivals(fixtures.raw_arrivals(t))
    ),
    "arrivals_with_id": arrivals_with_id,
    "arrivals_filled": _cleaned,
    "decode_port": decode_port,
    "decode_destination": decode_destination,
    "decode_origin": decode_origin,
    "decode_large_lookups": decode_large_lookups,
    "decode_hot_codes": decode_hot_codes,
    "derive_dates": derive_dates,
    "derive_year_month": derive_year_month,
    "derive_categories": derive_categories,
    "derive_same_state_flag": derive_same_state_flag,
    "visits": _visits,
    "visit_fact": _fact,
    "visitor_dim": lambda t: star.visitor_dim(_visits(t)),
    "arrival_date_dim": lambda t: star.arrival_date_dim(_visits(t)),
    "demographics_flat": demographics_flat,
    "demographics_total": lambda t: _decimals_as_double(_totals(t)),
    "demographics_race": _races,
    "top_ports": lambda t: reports.top_ports(_fact(t)),
    "visits_by_month_gender": visits_by_month_gender,
    "top_ports_population": lambda t: reports.top_ports_population(_fact(t), _totals(t)),
    "visits_by_visa": lambda t: reports.visits_by_visa(_fact(t)),
    "top_origins": lambda t: reports.top_origins(_fact(t)),
    "visits_by_month": lambda t: reports.visits_by_month(_fact(t)),
    "visits_by_mode": lambda t: reports.visits_by_mode(_fact(t)),
    "port_diversity": port_diversity,
    "dq_row_counts": lambda t: _star_report(t, "row_count"),
    "dq_unique_keys": lambda t: _star_report(t, "unique_key"),
    "dq_required": lambda t: _star_report(t, "required"),
    "dq_fit": demographics_fit,
    "rejected_values": lambda t: quality.rejected_report(fixtures.raw_arrivals(t)),
    "dq_key_surplus": lambda t: quality.surplus_rows(t.lineitem, LINEITEM.key),
    "dq_duplicate_keys": lambda t: quality.duplicate_keys(t.lineitem, LINEITEM.key),
    "dq_offending_keys": dq_offending_keys,
    "dq_offending_dates": dq_offending_dates,
    "load_counts": load_counts,
    "arrivals_layouts": arrivals_layouts,
    "gate_blocks_duplicates": gate_blocks_duplicates,
    "lookup_csv_roundtrip": lookup_csv_roundtrip,
    "arrivals_csv_roundtrip": arrivals_csv_roundtrip,
    "arrivals_parquet_roundtrip": arrivals_parquet_roundtrip,
    "fact_json_roundtrip": fact_json_roundtrip,
    "star_from_json": star_from_json,
    "publish_month_twice": publish_month_twice,
    "publish_month_append": publish_month_append,
    "publish_across_months": publish_across_months,
    "published_dates": published_dates,
    "published_less": published_less,
    "published_key_index": published_key_index,
    "staged_together": staged_together,
    "kept_counts": kept_counts,
    "kept_reports": kept_reports,
    "kept_port_diversity": kept_port_diversity,
    "published_top_ports": lambda t: over_published(t, reports.top_ports, "visitor_analysis"),
    "published_month_gender": lambda t: over_published(
        t, reports.visits_by_month_gender, "visitor_analysis", "visitors", "arrival_date"
    ),
    "published_month_gender_gated": lambda t: over_published(
        t,
        lambda *names: reports.visits_by_month_gender(*names, gated=True),
        "visitor_analysis",
        "visitors",
        "arrival_date",
    ),
    "published_top_ports_population": lambda t: over_published(
        t, reports.top_ports_population, "visitor_analysis", "state_demographics"
    ),
    "published_visits_by_visa": lambda t: over_published(
        t, reports.visits_by_visa, "visitor_analysis"
    ),
    "published_top_origins": lambda t: over_published(
        t, reports.top_origins, "visitor_analysis"
    ),
    "tables_dropped": tables_dropped,
    "demographics_from_json": lambda t: _demographics_from_json(t, schemas.STATE_DEMOGRAPHICS),
    "demographics_race_from_json": lambda t: _demographics_from_json(
        t, schemas.STATE_DEMOGRAPHICS_BY_RACE
    ),
    "refresh_demographics": lambda t: _refreshed_demographics(t, schemas.STATE_DEMOGRAPHICS),
    "refresh_demographics_race": lambda t: _refreshed_demographics(
        t, schemas.STATE_DEMOGRAPHICS_BY_RACE
    ),
}


def queries() -> dict[str, Query]:
    def over_tables(query: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: query(Tables(spark, sf_dir))

    return {name: over_tables(query) for name, query in QUERIES.items()}
