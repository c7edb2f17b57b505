import hashlib
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.operators.boilerplate import Thresholds
from tidemark.operators.classify import checked_prompt
from tidemark.operators.validate import ReleaseError
from tidemark.plans import pipeline, quality
from tidemark.sources.tables import table


def test_release_rules(spark, folder):
    release = quality.q_release(spark, folder).cache()
    assert release.columns[: len(pipeline.RELEASE)] == list(pipeline.RELEASE)
    weekly = release.where("gazette_type = 'weekly'")
    assert weekly.groupBy("vacancy_no").count().where("count > 1").count() == 0
    assert release.where("gazette_type = 'daily'").join(weekly, "vacancy_no", "left_semi").count() == 0
    assert release.where(F.col("description").rlike(r"[a-z]@[a-z]+\.example")).count() == 0
    assert release.where("salary_min > salary_max").count() == 0 and release.where("agency_canonical is null and ps_act_employer is not null").count() == 0
    raw = table(spark, folder, "gazette_vacancies_raw")
    assert set(r[0] for r in release.select("vacancy_no").collect()) == set(r[0] for r in raw.select("vacancy_no").collect())


def test_empty_build(spark, folder):
    raw = table(spark, folder, "gazette_vacancies_raw").drop("notice_id").limit(0)
    assert pipeline.build(raw, quality.build_inputs(spark, folder), {}, Thresholds()).count() == 0


def test_build_stops_where_a_layer_fails(spark, folder):
    raw, inputs = table(spark, folder, "gazette_vacancies_raw").drop("notice_id").distinct(), quality.build_inputs(spark, folder)
    with pytest.raises(ReleaseError, match="release rows"):
        pipeline.build(raw, inputs, {"combined": "weekly", "vacancy_only": "weekly"}, Thresholds(), expectations={"min_release_rows": 10**9})
    fixed = spark.createDataFrame([(raw.first()["vacancy_no"], "Reef Board")], "key string, name string")
    built = pipeline.build(raw, replace(inputs, fixed=fixed), {"combined": "weekly", "vacancy_only": "weekly"}, Thresholds())
    assert {(r["agency_canonical"], r["agency_group"]) for r in built.where(F.col("vacancy_no") == fixed.first()["key"]).collect()} == {("Reef Board", "Reef Board")}


def test_commands(spark, folder, tmp_path, capsys):
    assert main(["build", folder, str(tmp_path), "--min-titles", "2"]) == 0 and (tmp_path / "release.json").exists()
    bounds = tmp_path / "bounds.json"
    bounds.write_text(json.dumps({"min_release_rows": 10**9}))
    assert main(["validate", str(tmp_path / "release.parquet"), str(bounds)]) == 1
    assert main(["current", str(tmp_path / "release.parquet"), str(bounds)]) == 0 and main(["coverage", str(tmp_path / "release.parquet")]) == 0
    assert "release rows" in capsys.readouterr().out


def test_prompt_hash(tmp_path):
    (tmp_path / "p.txt").write_text("hello")
    (tmp_path / "v.json").write_text(json.dumps({"v1": hashlib.sha256(b"hello").hexdigest(), "v2": "x"}))
    assert checked_prompt(str(tmp_path / "p.txt"), str(tmp_path / "v.json"), "v1") == "hello"
    with pytest.raises(SystemExit):
        checked_prompt(str(tmp_path / "p.txt"), str(tmp_path / "v.json"), "v2")
