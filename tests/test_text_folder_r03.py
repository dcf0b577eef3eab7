"""Text tables: files that many tasks can read, parsed once."""

import glob

from cohortforge.session import scratch_path
from cohortforge.sources.io import parquet_copies, read_table_folder, write_text_folder


def test_text_is_written_in_bounded_files_and_parsed_once(spark):
    rows = [(i, None if i % 7 == 0 else f"a,\"{i}\" b") for i in range(1000)]
    folder = scratch_path(spark, "text-folder-test")
    write_text_folder({"events": spark.createDataFrame(rows, "row_id long, value string").coalesce(1)}, folder, rows_per_file=100)
    assert len(glob.glob(f"{folder}/EVENTS.csv.gz/*.gz")) == 10
    read = read_table_folder(spark, folder)
    kept = parquet_copies(read)
    plan = kept["events"]._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "csv" not in plan.split("Location")[0]
    assert kept["events"].schema == read["events"].schema
    assert sorted((int(r[0]), r[1]) for r in kept["events"].collect()) == rows
