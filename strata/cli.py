"""Command line of the jobs. The only place where errors become exit codes.

    python -m strata.cli bronze  --EXTERNAL_IP HOST:PORT --topic T --landing_path P --checkpoint C
    python -m strata.cli silver  --bronze_path P --silver_landing_layer S --checkpoint C
    python -m strata.cli publish --feed_path F --checkpoint C --EXTERNAL_IP HOST:PORT --topic T
    python -m strata.cli capture --EXTERNAL_IP HOST:PORT --topic T --output_path L --checkpoint C
    python -m strata.cli tail    --log_path L --checkpoint C --output_path P

``--log_path`` names a log kept as parquet files and stands in for ``--EXTERNAL_IP``, the
servers of a Kafka cluster.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.operators.compact import MIN_SHARE, NOTE_FROM_BYTES
from strata.session import build_session
from strata.sources import read_feed, read_file_log, read_kafka, read_kafka_tail, read_raw
from strata.streaming import (
    preview_tail,
    run_bronze,
    run_capture,
    run_publish,
    run_silver,
    tail_file_log,
)
from strata.streaming.silver import FOLD_EVERY

log = logging.getLogger(__name__)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strata")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, summary: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=summary)
        added.add_argument("--shuffle_partitions", type=int, help="shuffle partitions to start from")
        return added

    def log_place(added: argparse.ArgumentParser) -> None:
        place = added.add_mutually_exclusive_group(required=True)
        place.add_argument("--EXTERNAL_IP", help="Kafka servers, host:port")
        place.add_argument("--log_path", help="log kept as parquet files")

    bronze = job("bronze", "append a log to the raw table")
    log_place(bronze)
    bronze.add_argument("--topic", help="Kafka topic")
    bronze.add_argument("--landing_path", required=True, help="raw table")
    bronze.add_argument("--checkpoint", required=True, help="progress of this job")
    bronze.add_argument("--max_offsets", type=int, help="most records per micro-batch, Kafka")
    bronze.add_argument("--min_partitions", type=int, help="fewest read tasks, Kafka")
    bronze.add_argument("--max_records_per_task", type=int, help="most records per read task, Kafka")
    bronze.add_argument("--max_files", type=int, help="most files per micro-batch, file log")
    bronze.add_argument("--max_bytes", type=int, help="most bytes per micro-batch, file log")
    bronze.add_argument("--gather_dates", action="store_true", help="few files per date, for a backlog")
    gaps = bronze.add_mutually_exclusive_group()
    gaps.add_argument("--check_gaps", dest="gaps", action="store_const", const="fail",
                      help="fail before a micro-batch that leaves out offsets, file log")
    gaps.add_argument("--accept_gaps", dest="gaps", action="store_const", const="accept",
                      help="take a micro-batch that --check_gaps failed for")
    bronze.add_argument("--table_format", choices=["parquet", "delta"], default="parquet")

    silver = job("silver", "upsert the raw table into the current state")
    silver.add_argument("--bronze_path", required=True, help="raw table")
    silver.add_argument("--silver_landing_layer", required=True, help="current-state table")
    silver.add_argument("--checkpoint", required=True, help="progress of this job")
    limit = silver.add_mutually_exclusive_group()
    limit.add_argument("--max_files", type=int, help="most files per micro-batch")
    limit.add_argument("--max_bytes", type=int, help="most bytes per micro-batch")
    silver.add_argument("--table_format", choices=["parquet", "delta"], default="parquet")
    silver.add_argument("--min_share", type=float, default=MIN_SHARE, help="when to fold older folders")
    silver.add_argument("--note_from", type=int, default=NOTE_FROM_BYTES, help="size of folders to note, bytes")
    silver.add_argument("--by_event_time", action="store_true", help="the newer event wins, not the later batch")
    silver.add_argument("--rejects_path", help="where to keep the records that are dropped otherwise")
    silver.add_argument("--fold_every", type=int, default=FOLD_EVERY, help="micro-batches between folds")

    publish = job("publish", "publish the payloads of captured feed lines")
    publish.add_argument("--feed_path", required=True, help="folder of captured lines")
    to = publish.add_mutually_exclusive_group(required=True)
    to.add_argument("--EXTERNAL_IP", help="Kafka servers, host:port")
    to.add_argument("--output_path", help="files of payloads")
    publish.add_argument("--topic", help="Kafka topic")
    publish.add_argument("--max_files", type=int, help="most files per micro-batch")
    publish.add_argument("--checkpoint", required=True, help="progress of this job")

    capture = job("capture", "keep the records of a log as files")
    log_place(capture)
    capture.add_argument("--topic", help="Kafka topic")
    capture.add_argument("--output_path", required=True, help="log kept as parquet files")
    capture.add_argument("--checkpoint", required=True, help="progress of this job")

    tail = job("tail", "deliver the records that arrive from now on")
    log_place(tail)
    tail.add_argument("--topic", help="Kafka topic")
    tail.add_argument("--checkpoint", required=True, help="progress of this job, and its start")
    out = tail.add_mutually_exclusive_group(required=True)
    out.add_argument("--output_path", help="where to write all records")
    out.add_argument("--preview_rows", type=int, help="only print so many records of each micro-batch")
    tail.add_argument("--drain", action="store_true", help="stop when the log is read to its end")
    return parser


def _bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.EXTERNAL_IP:
        source = read_kafka(
            spark, args.EXTERNAL_IP, args.topic,
            max_offsets=args.max_offsets, min_partitions=args.min_partitions,
            max_records_per_task=args.max_records_per_task,
        )
    else:
        source = read_file_log(spark, args.log_path, max_files=args.max_files, max_bytes=args.max_bytes)
    run_bronze(
        source, args.landing_path, args.checkpoint, args.table_format,
        gather_dates=args.gather_dates, gaps=args.gaps,
    )


def _silver(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_raw(
        spark, args.bronze_path, table_format=args.table_format,
        max_files=args.max_files, max_bytes=args.max_bytes,
    )
    run_silver(
        raw, args.silver_landing_layer, args.checkpoint, table_format=args.table_format,
        min_share=args.min_share, note_from=args.note_from, fold_every=args.fold_every,
        by_event_time=args.by_event_time, rejects=args.rejects_path,
    )


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    run_publish(
        read_feed(spark, args.feed_path, max_files=args.max_files), args.checkpoint,
        topic=args.topic, path=args.output_path, servers=args.EXTERNAL_IP,
    )


def _capture(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.EXTERNAL_IP:
        source = read_kafka(spark, args.EXTERNAL_IP, args.topic)
    else:
        source = read_file_log(spark, args.log_path)
    run_capture(source, args.output_path, args.checkpoint)


def _tail(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.EXTERNAL_IP:
        source = read_kafka_tail(spark, args.EXTERNAL_IP, args.topic)
    else:
        source = tail_file_log(spark, args.log_path, args.checkpoint)
    if args.output_path:
        query = run_capture(source, args.output_path, args.checkpoint, drain=args.drain)
    else:
        query = preview_tail(
            source, rows=args.preview_rows, checkpoint=args.checkpoint, drain=args.drain
        )
    query.awaitTermination()


_JOBS = {
    "bronze": _bronze, "silver": _silver, "publish": _publish, "capture": _capture, "tail": _tail,
}


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "EXTERNAL_IP", None) and not args.topic:
        parser.error("--EXTERNAL_IP needs --topic")
    if getattr(args, "gaps", None) and args.EXTERNAL_IP:
        parser.error("--check_gaps is for file logs; Kafka's source tells lost data itself")
    try:
        spark = build_session(
            f"strata-{args.job}",
            shuffle_partitions=args.shuffle_partitions,
            delta=getattr(args, "table_format", None) == "delta",
        )
        _JOBS[args.job](spark, args)
    except KeyboardInterrupt:
        log.info("%s stopped", args.job)
    except Exception:
        log.exception("%s failed", args.job)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
