"""Append the records of JSON documents to a table, as a job with parameters:

    spark-submit --py-files finmart.zip finmart/plans/ingest_cli.py --input gs://bucket/pix.json --table pix --fields Data,Total

The target is ``--folder``, or the database of ``--jdbc-url``, whose user and password come from the environment
(``FINMART_DB_USER``, ``FINMART_DB_PASSWORD``).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from finmart.plans.publish import ingest_documents
from finmart.sources.layouts import strings
from finmart.sources.sinks import Folder, Relational


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Append the records of JSON documents to a table.")
    parser.add_argument("--input", required=True, help="file, folder or pattern of the documents")
    parser.add_argument("--table", required=True, help="name of the table")
    parser.add_argument("--fields", required=True, help="record fields, separated by commas; all are read as text")
    parser.add_argument("--per-line", action="store_true", help="a document per line instead of per file")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--folder", help="root folder of Parquet tables")
    target.add_argument("--jdbc-url", help="database to append to")
    parser.add_argument("--batch", type=int, default=1000, help="rows per insert")
    return parser.parse_args(argv)


def target_of(args: argparse.Namespace) -> Folder | Relational:
    if args.folder:
        return Folder(args.folder)
    login = {"user": "FINMART_DB_USER", "password": "FINMART_DB_PASSWORD"}
    return Relational(args.jdbc_url, {k: os.environ[v] for k, v in login.items() if v in os.environ})


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    outcome = ingest_documents(spark, args.input, strings(*args.fields.split(",")), args.table, target_of(args),
                               args.batch, args.per_line)[args.table]
    print(f"{args.table}: {outcome}")
    return 0 if outcome == "ok" else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
