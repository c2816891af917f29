import os

from tallyloom.plans import catalogue
from tallyloom.session import clear_shared, materialize, shared_dir, stamp


def test_folders_are_cleared(spark, monkeypatch):
    from tallyloom import session
    monkeypatch.setattr(session, "_made", {})  # what other tests made stays
    df = materialize(spark.range(5), "five")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 5 and os.path.exists(path)
    shared_dir(spark, "never-written")
    assert clear_shared(spark) == 2 and not os.path.exists(path) and clear_shared(spark) == 0


def test_staged_results_follow_the_tables(spark, tmp_path):
    folder = str(tmp_path)

    def staged():
        return catalogue.staged(spark, folder, "rows", lambda: spark.read.parquet(f"{folder}/region.parquet")).count()

    spark.range(3).write.parquet(f"{folder}/region.parquet")
    assert staged() == staged() == 3
    spark.range(4).write.mode("append").parquet(f"{folder}/region.parquet")
    assert staged() == 7 and stamp(spark, f"{folder}/nation.parquet") == (0, 0, 0)
