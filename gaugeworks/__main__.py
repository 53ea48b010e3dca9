"""Jobs to submit: ``ingest`` for recorded answers, ``daily`` for the batch, ``stream`` for the streaming queries.

    spark-submit ... -m gaugeworks ingest --recorded s3a://answers --root s3a://lake --servers broker:9092
    spark-submit ... -m gaugeworks daily --root s3a://lake --run-date 2024-03-01
    spark-submit ... -m gaugeworks stream --root s3a://lake --servers broker:9092
"""

from __future__ import annotations

import argparse

from gaugeworks.plans.daily_run import Paths, run_daily, status_frame
from gaugeworks.plans.ingest import ingest
from gaugeworks.schemas import BRONZE
from gaugeworks.session import build_session
from gaugeworks.sources.lake import TOPIC, decode, kafka_stream
from gaugeworks.streaming.jobs import await_any, dead_letter_job
from gaugeworks.streaming.sliding import start_all


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gaugeworks", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    daily = jobs.add_parser("daily", help="raw to bronze, silver and gold")
    daily.add_argument("--root", required=True)
    daily.add_argument("--run-date", default="", help="YYYY-MM-DD; empty for today in UTC")
    daily.add_argument("--through", default="", help="last day of a backfill")
    answers = jobs.add_parser("ingest", help="recorded API answers to published events")
    answers.add_argument("--recorded", required=True, help="folder of JSON answers")
    answers.add_argument("--root", required=True)
    answers.add_argument("--servers", help="without a broker, records go to the folder records below the root")
    answers.add_argument("--topic", default=TOPIC)
    stream = jobs.add_parser("stream", help="rolling averages, alerts and raw events")
    stream.add_argument("--root", required=True)
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topic", default=TOPIC)
    stream.add_argument("--records-per-batch", type=int, default=5_000_000, help="so much of a backlog at once")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.job == "daily":
        results = run_daily(spark, Paths.under(args.root), args.run_date, args.through)
        status_frame(spark, results).show(truncate=False)
        return
    root = args.root.rstrip("/")
    if args.job == "ingest":
        target = args.topic if args.servers else f"{root}/records"
        ingest(spark, args.recorded, target, f"{root}/unreadable_answers", servers=args.servers).show(truncate=False)
        return
    records = kafka_stream(spark, args.servers, args.topic, maxOffsetsPerTrigger=str(args.records_per_batch))
    dead_letter_job(records, f"{root}/unreadable_records", f"{root}/checkpoints/unreadable_records")
    start_all(decode(records, BRONZE, keep=("timestamp",)), args.root, arrival="timestamp")
    await_any(spark)


if __name__ == "__main__":
    main()
