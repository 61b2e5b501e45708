"""Command line: run, analyse, validate, audit, drift, search."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from chatmill.operators import retrieval
from chatmill.plans import pipeline
from chatmill.plans.session import SETTINGS
from chatmill.sources.exports import find_exports


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chatmill", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name, words in {"run": ("exports", "out"), "analyse": ("messages",), "validate": ("out",), "audit": ("messages",), "drift": ("reference", "current"), "search": ("chunks", "query")}.items():
        p = sub.add_parser(name)
        for w in words:
            p.add_argument(w)
        p.add_argument("--report", help="also write the result to this file")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("chatmill").config(map=SETTINGS).getOrCreate()
    read = spark.read.parquet
    if given.command == "run":
        result = pipeline.run(spark, find_exports(given.exports), given.out)
    elif given.command == "analyse":
        result = pipeline.analyse(read(given.messages))
    elif given.command == "validate":
        result = pipeline.validate(spark, given.out)
    elif given.command == "audit":
        result = pipeline.audit_report(read(given.messages))
    elif given.command == "drift":
        result = pipeline.compare(read(given.reference), read(given.current))
    else:
        result = [r.asDict() for r in retrieval.search(read(given.chunks), given.query, "chunk_id", "content").collect()]
    print(json.dumps(result, ensure_ascii=False, indent=2, default=str))
    if given.report:
        pipeline.save_report(result if isinstance(result, dict) else {"hits": result}, given.report)
    failed = given.command == "validate" and not result["overall_passed"] or given.command == "audit" and result["verdict"] != "PASSED" or given.command == "drift" and result["overall_verdict"] == "significant_drift"
    return int(failed)


if __name__ == "__main__":
    raise SystemExit(main())
