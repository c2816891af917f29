"""From a folder of CSV files to tables, profile, report and example questions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.models import ExtractiveAnswer
from tallyloom.operators import context, profile as profiles, report
from tallyloom.session import at_once
from tallyloom.sources import catalog, files, writers

# The steps of onboarding, in order.
STEPS = ("ingest", "profile", "dashboard", "summary", "questions")

SUMMARY_REQUEST = (
    "For each table say what one row stands for, which columns identify it and which time span it covers. "
    "Then name the columns by which tables can be joined. Leave out what the schema does not say."
)


@dataclass
class Dataset:
    """Where a dataset comes from and goes to. ``output`` is a folder for profile and texts."""
    source: str
    database: str
    output: str
    explicit: list[str] | None = None
    max_mb: float | None = None
    include_large: bool = False
    exact: bool = True


@dataclass
class Onboarded:
    results: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, step: str) -> DataFrame:
        return self.results[step]


def onboard(spark: SparkSession, dataset: Dataset, skip: tuple[str, ...] = (), dry_run: bool = False,
            make_generator=ExtractiveAnswer) -> Onboarded:
    """Run the steps that are not skipped. Running again replaces tables and outputs. A dry
    run only previews the load. ``skipped`` lists the files left out, with reasons."""
    unknown = set(skip) - set(STEPS)
    if unknown:
        raise ValueError(f"Unknown step(s) {sorted(unknown)}. Valid: {', '.join(STEPS)}")
    done = Onboarded()
    if "ingest" not in skip:
        found = files.discover_files(spark, dataset.source, dataset.explicit, dataset.max_mb, dataset.include_large)
        done.results["skipped"] = files.skipped(found)
        if dry_run:
            done.results["preview"] = files.preview(spark, found)
            return done
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset.database}`")
        loaded = files.load_csv_folder(spark, found)
        at_once(spark, lambda item: writers.save_table(item[1][0], f"{dataset.database}.{item[0]}"), loaded.items())
        done.results["ingest"] = writers.reconcile(
            {t: spark.table(f"{dataset.database}.{t}") for t in loaded}, {t: n for t, (_, n) in loaded.items()})
    if dry_run:
        return done
    tables = catalog.read_tables(spark, dataset.database)
    if "profile" not in skip:
        if not tables:
            raise ValueError(f"No tables in {dataset.database}")
        found = profiles.profile_tables(tables, dataset.exact)
        writers.write_profile(found, f"{dataset.output}/profile")
        stored = spark.read.parquet(f"{dataset.output}/profile/parquet")
        writers.write_text(report.data_dictionary(stored), "section", f"{dataset.output}/data_dictionary", f"Data dictionary of {dataset.database}")
        done.results["profile"] = stored
    stored = spark.read.parquet(f"{dataset.output}/profile/parquet")
    if "dashboard" not in skip:
        done.results["dashboard"] = report.report_datasets(stored, tables)
    if "summary" not in skip:
        done.results["summary"] = summarize(stored, dataset.database, make_generator)
        writers.write_text(done["summary"], "answer", f"{dataset.output}/summary")
    if "questions" not in skip:
        done.results["questions"] = report.example_questions(stored)
        writers.write_text(done["questions"], "question", f"{dataset.output}/questions", f"Questions to ask of {dataset.database}", marked=True)
    return done


def summarize(profile: DataFrame, schema: str, make_generator=ExtractiveAnswer) -> DataFrame:
    """One row: what a model makes of the schema text."""
    text = report.schema_text(profile, schema).selectExpr("'summary' AS query_id", "schema_text")
    request = text.select("query_id", F.lit(SUMMARY_REQUEST).alias("text"))
    contexts = text.selectExpr("query_id", "schema_text AS context")
    return context.answer(context.prompt_rows(contexts, request), make_generator)
