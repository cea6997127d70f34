"""`spark-submit` entry: run the flow described in a JSON or YAML file."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from sluiceway import FlowReport, FlowSpec, run


def main(arguments: list[str]) -> int:
    if len(arguments) != 1:
        print("usage: python -m sluiceway FLOW_FILE", file=sys.stderr)
        return 2
    spec = FlowSpec.from_file(arguments[0])
    spark = SparkSession.builder.appName("sluiceway").getOrCreate()
    try:
        result = run(spark, spec)
        if isinstance(result, FlowReport):
            print(f"wrote {result.rows} rows")
        else:
            result.awaitTermination()
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
