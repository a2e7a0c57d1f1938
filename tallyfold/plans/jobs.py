"""Load, frequencies, statistics, box plots and cohort tables: each job writes its results."""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallyfold.functions.scalars import component_rank
from tallyfold.operators.boxplot import annotate, boxes_of_ranks, boxplot_order
from tallyfold.operators.checks import require_valid
from tallyfold.operators.cohort import (
    baseline_cohort, breakdown, cohort_profile, comparison_cohort)
from tallyfold.operators.compare import (
    one_scope, per_timepoint, scope_ranks, scope_statistics, stats_order)
from tallyfold.operators.composition import composition, composition_of_wide
from tallyfold.operators.normalize import normalize, sample_metadata, with_metadata
from tallyfold.operators.skew import parts_of
from tallyfold.plans.summary import significance_summary
from tallyfold.sources.tables import (
    drop_folder, new_run, prune_runs, publish, published_run, read_optional, read_tables, scope,
    staged, write_table, write_tables, write_together)
from tallyfold.sources.wide_csv import write_wide
from tallyfold.study import CLINICAL, METADATA, STATS, Study

KEEP_RUNS = 2


def load(spark: SparkSession, path: str, out_dir: str, study: Study = CLINICAL, *,
         keep_runs: int = KEEP_RUNS) -> dict[str, DataFrame]:
    """Validate the wide CSV and rebuild the four tables; returns them as published, with the typed
    ``wide`` rows they were made from.

    The CSV is parsed once, into a typed Parquet copy that checks and tables are read from. A run
    that fails is deleted and never published, so the previous tables stay current; of the
    published runs the last ``keep_runs`` are kept.
    """
    run, folder = new_run(f"{out_dir}/tables")
    try:
        wide = write_wide(spark, path, study, f"{folder}/wide")
        require_valid(wide, study)
        write_tables(normalize(wide, study), folder)
    except BaseException:
        drop_folder(spark, folder)
        raise
    publish(spark, f"{out_dir}/tables", run)
    prune_runs(spark, f"{out_dir}/tables", keep_runs)
    return _tables_of(spark, folder)


def _tables_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {**read_tables(spark, folder), "wide": spark.read.parquet(f"{folder}/wide")}


def current_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame] | None:
    folder = published_run(spark, f"{out_dir}/tables")
    return None if folder is None else _tables_of(spark, folder)


def table_frequencies(tables: dict[str, DataFrame], study: Study) -> DataFrame:
    """Composition of the count table, whose samples have one row per listed component."""
    counts = tables["cell_counts"].withColumnRenamed("sample_id", "sample")
    return composition(counts, one_row_per_component=True)


def ordered_frequencies(tables: dict[str, DataFrame], study: Study) -> DataFrame:
    """The same in canonical order. Wide rows are totalled along the row, sorted, and then unpivoted
    in component order, so one row per sample moves. Without them, one range partitioning of the
    count table by sample, into parts by the number of samples, and one sort in each part serve the
    totals and the global order alike."""
    if "wide" in tables:
        columns = tables["wide"].select("sample", *study.components)
        return composition_of_wide(columns.orderBy("sample"), study.components)
    counts = tables["cell_counts"].withColumnRenamed("sample_id", "sample")
    rank = component_rank(F.col("population"), study.components)
    order = [F.col("sample").asc(), F.col("_rank").asc_nulls_last()]
    parts = parts_of(counts.sparkSession, tables["samples"].count() * len(study.components))
    ranged = counts.repartitionByRange(parts, "sample").withColumn("_rank", rank)
    return composition(ranged.sortWithinPartitions(*order), keep=["_rank"],
                       one_row_per_component=True).orderBy(*order).drop("_rank")


def metadata_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Sample metadata: a projection of the wide rows where there are any, else joined."""
    if "wide" in tables:
        return tables["wide"].select(*METADATA)
    return sample_metadata(tables, keys_checked=True)


class CohortCheck:
    """What the cohort should hold and what it holds, observed while it is written: rows, and the sum
    of the hashes of (sample, component), which differs where keys are lost, repeated or swapped."""

    def __init__(self, study: Study):
        self.study, self.expected, self.found = study, Observation(), Observation()

    @staticmethod
    def _hash(*key: Column) -> Column:
        return F.xxhash64(*key).cast("decimal(38,0)")

    def chosen(self, samples: DataFrame) -> DataFrame:
        """Watch the cohort's samples: each should have a row for every component."""
        hashes = [self._hash(F.col("sample"), F.lit(c)) for c in self.study.components]
        return samples.observe(
            self.expected, (F.count(F.lit(1)) * F.lit(len(hashes))).alias("rows"),
            F.sum(reduce(Column.__add__, hashes)).alias("keys"))

    def rows(self, cohort: DataFrame) -> DataFrame:
        """Watch the cohort's rows."""
        key = self._hash(F.col("sample"), F.col("population"))
        return cohort.observe(self.found, F.count(F.lit(1)).alias("rows"), F.sum(key).alias("keys"))

    def agrees(self) -> bool:
        """After the write: whether rows and keys are those expected."""
        return self.expected.get == self.found.get


def cohort_frequencies(tables: dict[str, DataFrame], study: Study,
                       check: CohortCheck | None = None) -> DataFrame:
    """Frequency rows with metadata of the comparison cohort; ``check`` watches its samples.

    The cohort is chosen before anything is totalled: totals are per sample, so leaving out whole
    samples first changes no percentage. Wide rows need no shuffle; else one partitioning by sample
    serves the join and the totals.
    """
    watch = (lambda samples: samples) if check is None else check.chosen
    if "wide" in tables:
        wide = tables["wide"].select(*METADATA, *study.components)
        return composition_of_wide(watch(comparison_cohort(wide, study)), study.components,
                                   keep=METADATA[1:])
    chosen = watch(comparison_cohort(metadata_of(tables), study))
    counts = tables["cell_counts"].withColumnRenamed("sample_id", "sample")
    return composition(with_metadata(counts, chosen), keep=METADATA[1:],
                       one_row_per_component=True)


def require_whole_cohort(cohort: DataFrame, metadata: DataFrame, study: Study) -> None:
    """Each cohort sample must have one row for each component, no more and no less."""
    components = F.explode(F.array(*[F.lit(c) for c in study.components])).alias("population")
    expected = comparison_cohort(metadata, study).select("sample", components)
    rows = expected.select("*", F.lit(1).alias("expected"), F.lit(0).alias("found")).unionAll(
        cohort.select("sample", "population", F.lit(0), F.lit(1)))
    odd = rows.groupBy("sample", "population").agg(
        F.sum("expected").alias("expected"), F.sum("found").alias("found")).where(
        "expected <> 1 OR found <> 1").limit(3).collect()
    if odd:
        raise ValueError("the cohort join must give one row for each sample and component, first "
                         f"others: {[tuple(r) for r in odd]} (sample, component, expected, found)")


def _written(df: DataFrame, path: str, fmt: str, **options) -> DataFrame:
    """``df`` written to ``path`` and read back under its own types."""
    write_table(df, path, fmt, **options)
    return read_optional(df.sparkSession, path, fmt, df.schema)


def _written_together(made: dict[str, DataFrame], out_dir: str, fmt: str) -> dict[str, DataFrame]:
    write_together(made, out_dir, fmt)
    return {name: read_optional(df.sparkSession, f"{out_dir}/{name}", fmt, df.schema)
            for name, df in made.items()}


def frequencies_job(tables: dict[str, DataFrame], out_dir: str, study: Study = CLINICAL,
                    fmt: str = "csv") -> DataFrame:
    return _written(ordered_frequencies(tables, study), f"{out_dir}/cell_frequencies", fmt)


def statistics_job(ranks: DataFrame, metadata: DataFrame, out_dir: str, study: Study = CLINICAL,
                   fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """All scopes' statistics and the summary text; returns the written table and the text's lines."""
    spark = ranks.sparkSession
    stats = scope_statistics(ranks, study)
    # At most one row per scope and component.
    written = _written(stats.coalesce(1).sortWithinPartitions(*stats_order(study)),
                       f"{out_dir}/stats", fmt, partition_by="scope")
    profile = cohort_profile(comparison_cohort(metadata, study), study)
    summary = significance_summary(written, profile, study)
    text = spark.range(1).select(F.lit(summary).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(f"{out_dir}/stats_summary")
    return written, spark.read.schema("line string").text(f"{out_dir}/stats_summary")


def boxplot_job(ranks: DataFrame, out_dir: str, study: Study = CLINICAL,
                fmt: str = "csv") -> dict[str, DataFrame]:
    """Data of the box plots that needs no statistics: boxes by time and all outliers."""
    timed, timed_outliers = boxes_of_ranks(ranks, study, by_time=True)
    return _written_together({
        "boxplot_outliers": boxes_of_ranks(ranks, study)[1],
        "boxplots_per_timepoint": timed.orderBy(*boxplot_order(study, by_time=True)),
        "boxplot_outliers_per_timepoint": timed_outliers,
    }, out_dir, fmt)


def annotated_boxplot_job(ranks: DataFrame, stats: DataFrame, out_dir: str,
                          study: Study = CLINICAL, fmt: str = "csv") -> DataFrame:
    """The pooled boxes, annotated with the baseline p-values."""
    boxes = annotate(boxes_of_ranks(ranks, study)[0], stats.where(F.col("scope") == "baseline"),
                     study)
    return _written(boxes.orderBy(*boxplot_order(study)), f"{out_dir}/boxplots", fmt)


def cohort_job(metadata: DataFrame, out_dir: str, study: Study = CLINICAL,
               fmt: str = "csv") -> dict[str, DataFrame]:
    """Baseline cohort, written by sample, and the breakdowns of the written rows."""
    chosen = _written(baseline_cohort(metadata, study).orderBy("sample"),
                      f"{out_dir}/part4_baseline_samples", fmt)
    return {"part4_baseline_samples": chosen, **_written_together({
        "part4_by_project": breakdown(chosen, "project"),
        "part4_by_response": breakdown(chosen, "response", one_per="subject"),
        "part4_by_sex": breakdown(chosen, "sex", one_per="subject"),
    }, out_dir, fmt)}


def analyse(tables: dict[str, DataFrame], out_dir: str, study: Study = CLINICAL,
            fmt: str = "csv", *, keep_runs: int = KEEP_RUNS) -> dict[str, DataFrame]:
    """Everything after the load, into a run folder that is published when all of it is written;
    returns the tables as written. A failed run is deleted and leaves the published one as it was.

    The cohort's rows and their ranked histogram are written once; statistics and box plots read
    that. Tables that nothing waits for are written meanwhile.
    """
    spark = tables["samples"].sparkSession
    with scope(spark):
        return _analysed(spark, tables, out_dir, study, fmt, keep_runs)


def _analysed(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str, study: Study,
              fmt: str, keep_runs: int) -> dict[str, DataFrame]:
    metadata = metadata_of(tables)
    run, folder = new_run(out_dir)
    try:
        check = CohortCheck(study)
        cohort = _written(check.rows(cohort_frequencies(tables, study, check)),
                          f"{folder}/cohort_frequencies", "parquet")
        if not check.agrees():  # say which keys
            require_whole_cohort(cohort, metadata, study)
        with ThreadPoolExecutor(max_workers=3) as pool:
            frequencies = pool.submit(frequencies_job, tables, folder, study, fmt)
            breakdowns = pool.submit(cohort_job, metadata, folder, study, fmt)
            ranks = staged(scope_ranks(cohort, study), "ranks")
            boxes = pool.submit(boxplot_job, ranks, folder, study, fmt)
            stats, summary = statistics_job(ranks, metadata, folder, study, fmt)
            made = {"cell_frequencies": frequencies.result(), "stats": stats,
                    "stats_summary": summary,
                    "boxplots": annotated_boxplot_job(ranks, stats, folder, study, fmt),
                    **boxes.result(), **breakdowns.result()}
    except BaseException:
        drop_folder(spark, folder)
        raise
    publish(spark, out_dir, run)
    prune_runs(spark, out_dir, keep_runs)
    return made


def run_study(spark: SparkSession, path: str, out_dir: str, study: Study = CLINICAL,
              fmt: str = "csv") -> dict[str, DataFrame]:
    """From the wide CSV to every result table and the summary text."""
    return analyse(load(spark, path, out_dir, study), f"{out_dir}/results", study, fmt)


def saved_statistics(spark: SparkSession, out_dir: str, scope: str | None = None,
                     study: Study = CLINICAL, fmt: str = "csv") -> DataFrame:
    """The published statistics of one scope (pooled, baseline, t=..), or without ``scope`` of all
    time points, the time point first."""
    folder = published_run(spark, out_dir)
    stats = None if folder is None else read_optional(spark, f"{folder}/stats", fmt, STATS)
    if stats is None:
        raise FileNotFoundError(f"no statistics published under {out_dir}")
    return per_timepoint(stats, study) if scope is None else one_scope(stats, scope, study)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyfold", description=run_study.__doc__)
    parser.add_argument("step", choices=["load", "analyse", "all"])
    parser.add_argument("out_dir")
    parser.add_argument("--csv", help="wide input, needed by load and all")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    args = parser.parse_args(argv)
    if args.step != "analyse" and not args.csv:
        parser.error("--csv is needed")
    spark = SparkSession.builder.appName("tallyfold").getOrCreate()
    if args.step == "load":
        load(spark, args.csv, args.out_dir)
    elif args.step == "all":
        tables = load(spark, args.csv, args.out_dir)
        analyse(tables, f"{args.out_dir}/results", fmt=args.format)
    else:
        tables = current_tables(spark, args.out_dir)
        if tables is None:
            parser.error(f"no tables published under {args.out_dir}")
        analyse(tables, f"{args.out_dir}/results", fmt=args.format)


if __name__ == "__main__":
    main()
