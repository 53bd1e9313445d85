"""Run a job on CSV or log files: ``spark-submit ... -m tallyward JOB --input PATH [PATH2] --output PATH``.

The two-table jobs take the order file and the receipt file. Results are written as Parquet.

With ``--stream`` the job runs on: inputs are folders to which files are added, results and checkpoint go below the output folder,
``--delay`` is how late rows may be. With ``--once`` it takes what is there and stops; it goes on from there when started again.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.plans import jobs
from tallyward.session import ROCKSDB_STORE
from tallyward.sources import lines
from tallyward.streaming.jobs import IN_ORDER
from tallyward.streaming.starts import starts

# Arrival order of a file's rows where a rule needs one to break ties.
_SEQ = "seq"


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    return lines.numbered_lines(spark, path, _SEQ)


def _records(spark: SparkSession, path: str, schema, unit: str = lines.SECONDS) -> DataFrame:
    return lines.parsed_only(lines.parse_records(_numbered_lines(spark, path), schema, unit, keep=[_SEQ]))


def _behaviors(job: Callable[[DataFrame], DataFrame]):
    return lambda spark, paths: job(_records(spark, paths[0], schemas.USER_BEHAVIOR))


def _web_log(job: Callable[[DataFrame], DataFrame]):
    return lambda spark, paths: job(lines.parsed_only(lines.parse_web_log(lines.read_lines(spark, paths[0]))))


def _arrivals(job):
    """Web-log rows with their arrival number; the file's own order is the arrival order."""

    def run(spark, paths):
        return job(lines.parsed_only(lines.parse_web_log(_numbered_lines(spark, paths[0]), keep=[_SEQ])), _SEQ)

    return run


def _marketing(job):
    return lambda spark, paths: job(_records(spark, paths[0], schemas.MARKETING, lines.MILLIS))


def _ordered(schema, job):
    return lambda spark, paths: job(_records(spark, paths[0], schema), [_SEQ])


def _payments(job):
    def run(spark, paths):
        pays = jobs.payments(_records(spark, paths[0], schemas.ORDER))
        return job(pays, _records(spark, paths[1], schemas.RECEIPT))

    return run


JOBS = {
    "hot_items": _behaviors(jobs.hot_items),
    "hot_items_sql": _behaviors(jobs.hot_items_sql),
    "hot_items_report": _behaviors(jobs.hot_items_report),
    "page_views": _behaviors(jobs.page_views),
    "page_views_salted": _behaviors(jobs.page_views_salted),
    "unique_visitors": _behaviors(jobs.unique_visitors),
    "unique_visitors_bitmap": _behaviors(jobs.unique_visitors_bitmap),
    "unique_visitors_sketch": _behaviors(jobs.unique_visitors_sketch),
    "top_pages": _web_log(jobs.top_pages),
    "top_pages_report": _web_log(jobs.top_pages_report),
    "top_pages_in_arrival_order": _arrivals(jobs.top_pages_in_arrival_order),
    "late_requests": _arrivals(jobs.late_requests),
    "channel_counts": _marketing(jobs.channel_counts),
    "ad_blacklist": _ordered(schemas.AD_CLICK, jobs.ad_blacklist),
    "province_counts": _ordered(schemas.AD_CLICK, jobs.province_counts),
    "login_pairs": _ordered(schemas.LOGIN, jobs.login_pairs),
    "login_times": _ordered(schemas.LOGIN, jobs.login_times),
    "login_strict": _ordered(schemas.LOGIN, jobs.login_strict),
    "login_anchored": _ordered(schemas.LOGIN, jobs.login_anchored),
    "order_payments": _ordered(schemas.ORDER, jobs.order_payments),
    "order_life_cycle": lambda spark, paths: jobs.order_life_cycle(_records(spark, paths[0], schemas.ORDER)),
    "pay_receipt_join": _payments(jobs.pay_receipt_join),
    "pay_receipt_pairs": _payments(jobs.pay_receipt_pairs),
    "pay_receipt_reconcile": _payments(lambda pays, receipts: jobs.pay_receipt_reconcile(pays, receipts, _SEQ)),
    "single_pays": _payments(jobs.single_pays),
    "single_receipts": _payments(jobs.single_receipts),
    "pays_with_receipt": _payments(jobs.pays_with_receipt),
}


STREAMS = starts()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyward", description=__doc__)
    parser.add_argument("job", choices=sorted({*JOBS, *STREAMS}))
    parser.add_argument("--input", nargs="+", required=True, help="input file or folder (two for payment jobs)")
    parser.add_argument("--output", required=True, help="folder for the Parquet result")
    parser.add_argument("--stream", action="store_true", help="run on folders to which files are added")
    parser.add_argument("--once", action="store_true", help="with --stream: take what is there, then stop")
    parser.add_argument("--delay", default=IN_ORDER, help="with --stream: how late rows may be, for example '3 seconds'")
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"tallyward {chosen.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if chosen.stream:
        if chosen.job not in STREAMS:
            parser.error(f"{chosen.job} does not run as a stream; these do: {', '.join(sorted(STREAMS))}")
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STORE)
        STREAMS[chosen.job](spark, chosen.input, chosen.output, chosen.delay, chosen.once).awaitTermination()
        return
    if chosen.job not in JOBS:
        parser.error(f"{chosen.job} runs as a stream only")
    JOBS[chosen.job](spark, chosen.input).write.mode("errorifexists").parquet(chosen.output)


if __name__ == "__main__":
    main()
