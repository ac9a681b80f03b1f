from __future__ import annotations

from uuid import uuid4

import pytest
from helpers import arrivals, lookup_frames, rows

from arrivals_engine import jobs
from arrivals_engine.operators.quality import QualityError


def test_load_from_files_to_tables(spark, tmp_path):
    db = f"jobs_{uuid4().hex}"

    def run(*args):
        jobs.main(["--db", db, *map(str, args)], spark)

    codes = []
    for option, frame in zip(("--ports", "--destinations", "--origins"), lookup_frames(spark)):
        path = tmp_path / option.strip("-")
        frame.write.csv(str(path), header=True)
        codes += [option, path]
    good, bad = tmp_path / "good", tmp_path / "bad"
    arrivals(spark, {}, {"admnum": 2.0, "i94port": "?"}).write.parquet(str(good))
    arrivals(spark, {}, {"gender": "M"}).write.parquet(str(bad))

    run("create", "--location", tmp_path / "db")
    run("arrivals", good, *codes, "--json-out", tmp_path / "json")
    with pytest.raises(QualityError):
        run("arrivals", bad, *codes)
    fact = rows(spark.table(f"{db}.visitor_analysis").select("admission_id", "port_city"))
    assert fact == [(1, "NEW YORK"), (2, "Other")]

    run("create", "--drop")
    assert spark.table(f"{db}.visitor_analysis").count() == 0
    run("load-json", *(tmp_path / "json" / n for n in ("visitor_analysis", "visitors", "arrival_date")))
    assert rows(spark.table(f"{db}.visitor_analysis").select("admission_id", "port_city")) == fact

    nested = tmp_path / "nested"
    spark.sql(
        """SELECT 'd' AS datasetid, named_struct(
             'city', 'NEW YORK', 'state_code', 'NY', 'state', 'New York', 'race', race,
             'count', 5, 'total_population', 10, 'median_age', 35.5) AS fields
           FROM VALUES ('White'), ('Asian') AS t(race)"""
    ).write.json(str(nested))
    run("demographics", nested, "--json-out", tmp_path / "json")
    assert spark.table(f"{db}.state_demographics").count() == 1
    assert spark.read.json(str(tmp_path / "json" / "state_demographics_by_race")).count() == 2
    spark.sql(f"DROP DATABASE {db} CASCADE")
