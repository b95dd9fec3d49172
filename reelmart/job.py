"""The scheduled job: ``spark-submit -m reelmart.job config.json [--months 2025-01-01,...] [--onwards]``.

The configuration names everything by catalog table::

    {"inputs": {"basic": "lake.reports.basic", ...},
     "title_rules": "lake.reports.title_rules",
     "outputs": {"monthly_video": "lake.marts.monthly_video", ...},
     "audit": "lake.marts.audit",
     "create_under": "s3://bucket/marts"}

``create_under`` is optional and creates absent tables below that path.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.functions.fixed_values import INITIAL_DATE
from reelmart.functions.titles import title_rules_from
from reelmart.loading.run import Run
from reelmart.sources.inputs import Inputs


def run_job(
    spark: SparkSession, config: Mapping, months_to_reprocess: str | None = None, onwards: bool = False
) -> DataFrame:
    """One run by configuration; returns its audit rows."""
    run = Run(
        spark,
        Inputs.from_catalog(spark, config["inputs"]),
        title_rules_from(spark.table(config["title_rules"])),
        config["outputs"],
        config["audit"],
        initial=config.get("initial", INITIAL_DATE),
        strict_max=config.get("strict_max", False),
    )
    if "create_under" in config:
        run.create_tables(config["create_under"])
    return run.execute(months_to_reprocess, onwards)


def summary(audit: DataFrame) -> list[str]:
    """One line for each output, status and message; the audit table has every period."""
    ends = F.min("PERIOD_START").alias("first"), F.max("PERIOD_END").alias("last")
    found = audit.groupBy("OUTPUT", "STATUS", "MESSAGE").agg(F.count(F.lit(1)).alias("n"), F.sum("ROWS").alias("rows"), *ends)
    return [
        f"{r.OUTPUT}: {r.STATUS}, {r.n} periods ({r.first} to {r.last}), {r.rows or 0} rows" + (f": {r.MESSAGE}" if r.MESSAGE else "")
        for r in found.orderBy("OUTPUT", "STATUS", "MESSAGE").collect()
    ]


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("config")
    parser.add_argument("--months", help="first days of months to rebuild, separated by commas")
    parser.add_argument("--onwards", action="store_true", help="rebuild everything from the earliest of them")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("reelmart").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    with open(args.config, encoding="utf-8") as f:
        audit = run_job(spark, json.load(f), args.months, args.onwards)
    for line in summary(audit):
        print(line)


if __name__ == "__main__":
    main()
