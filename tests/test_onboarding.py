import json

import pytest

from tallyloom.plans.onboarding import Dataset, onboard
from tallyloom.sources import catalog


@pytest.fixture
def dataset(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "Weather Stations.csv").write_text(
        "Climate,Station ID,Height M\n" + "".join(f"{'Coast' if i % 3 else 'Alpine'},W-{i},{i}.5\n" for i in range(60)))
    (source / "Readings.csv").write_text("Reading ID,Taken Date,Rain Mm\n" + "".join(f"{i},2024-0{1 + i % 3}-05,{i % 7}\n" for i in range(90)))
    (source / "data_dictionary.csv").write_text("Table,Field\nx,y\n")
    return Dataset(str(source), "weather", str(tmp_path / "out"))


def test_everything_in_one_go(spark, dataset, tmp_path):
    done = onboard(spark, dataset)
    assert {tuple(r) for r in done["ingest"].collect()} == {("weather_stations", 60, 60, "OK"), ("readings", 90, 90, "OK")}
    keys = {(r.table_name, r.column_name) for r in done["profile"].where("is_inferred_primary_key").collect()}
    assert keys == {("weather_stations", "station_id"), ("readings", "reading_id")}
    report = {(r.dataset, r.label): r.n for r in done["dashboard"].collect()}
    assert report[("ds_weather_stations_climate_top", "Coast")] == 40 and report[("ds_readings_taken_date_trend", "2024-02")] == 30
    written = (p.read_text() for p in (tmp_path / "out/questions").glob("part*"))
    assert "".join(written).startswith("# Questions to ask of weather\n\n- What's the range and average rain_mm in `readings`?\n")
    assert done["questions"].first().question == "What's the range and average rain_mm in `readings`?"
    assert done["summary"].count() == 1
    nested = [json.loads(line) for f in (tmp_path / "out/profile/json/table_name=readings").glob("part*") for line in f.read_text().splitlines()]
    assert [c["column_name"] for c in nested[0]["columns"]] == ["reading_id", "taken_date", "rain_mm"] and nested[0]["row_count"] == 90
    assert catalog.table_profile(done["profile"], "readings").count() == 3
    with pytest.raises(ValueError):
        catalog.table_profile(done["profile"], "nope")
    again = onboard(spark, dataset, skip=("dashboard", "summary", "questions"))
    assert again["ingest"].where("status <> 'OK'").isEmpty() and catalog.managed_tables(spark, "weather") == ["readings", "weather_stations"]


def test_dry_run_changes_nothing(spark, dataset, tmp_path):
    dataset.database = "untouched"
    done = onboard(spark, dataset, dry_run=True)
    assert {(r.table_name, r.reason is None) for r in done["preview"].collect()} == {("weather_stations", True), ("readings", True), (None, False)}
    assert {r.file for r in done["skipped"].collect()} == {"data_dictionary.csv"}
    assert not spark.catalog.databaseExists("untouched") and not (tmp_path / "out").exists()


def test_unknown_step(spark, dataset):
    with pytest.raises(ValueError, match="Unknown step"):
        onboard(spark, dataset, skip=("publish",))
