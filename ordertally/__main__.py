"""Run the streaming job: spark-submit ordertally/__main__.py CONFIG"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from ordertally.settings import read_settings
from ordertally.streaming.jobs import ProgressLog, run, wait


def main(config_path: str) -> None:
    # FAIR, so that the archive's tasks do not hold up the totals.
    builder = SparkSession.builder.appName("ordertally").config("spark.scheduler.mode", "FAIR")
    spark = builder.getOrCreate()
    # Session times are UTC, like the times in the tables.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.streams.addListener(ProgressLog())
    wait(spark, run(spark, read_settings(config_path)))


if __name__ == "__main__":
    main(sys.argv[1])
