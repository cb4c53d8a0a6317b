"""Command line: process, status, results, pause, resume, stop."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from narrata import api
from narrata.operators import jobs
from narrata.sources import files


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="narrata")
    parser.add_argument("command", choices=("process", "status", "results", "pause", "resume", "stop"))
    parser.add_argument("folder", help="folder of the batch's results and log")
    parser.add_argument("--job", required=True)
    parser.add_argument("--input", help="JSON lines of documents")
    parser.add_argument("--chunk", type=int, help="documents between two looks at the batch's state")
    parser.add_argument("--total", type=int, default=0)
    given = parser.parse_args(argv)
    spark = SparkSession.builder.appName("narrata").getOrCreate()
    if given.command == "process":
        print(json.dumps(api.run_batch(spark, files.json_lines(spark, given.input), given.folder, given.job, chunk_documents=given.chunk)))
    elif given.command == "status":
        print(json.dumps(api.job_status(spark, given.folder, given.job, given.total)))
    elif given.command == "results":
        for row in files.recent_rows(spark.read.parquet(f"{given.folder}/documents").selectExpr("*", "job_id AS batch_id", "published AS processed_at"), given.job).toJSON().toLocalIterator():
            print(row)
    else:
        getattr(jobs.Batch(spark, f"{given.folder}/log", given.job), given.command)()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
