"""Command line of the jobs, for spark-submit.

    spark-submit metricloom_job.py cleanse videos --landing hdfs:///landing/channels/*/videos/*/statistics \\
        --tables hdfs:///tables
    spark-submit metricloom_job.py enrich videos --tables jdbc:postgresql://db/batch --jdbc user=reports
    spark-submit metricloom_job.py consume comments --servers broker:9092 --topic comments --to comments_out \\
        --checkpoint hdfs:///checkpoints/consume-comments --every "1 second"
    spark-submit metricloom_job.py report a25 --tables hdfs:///tables --table comments_enriched --target author_profile

A JDBC password is read from METRICLOOM_JDBC_PASSWORD, never from the command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from metricloom.operators.envelope import nested_item
from metricloom.plans.cleanse import run_cleanse
from metricloom.plans.consume import preview_consume, run_consume
from metricloom.plans.dated import preview_dated, run_dated
from metricloom.plans.enrich import ENRICH, run_enrich
from metricloom.plans.changes import update_changes
from metricloom.plans.refresh import refreshed
from metricloom.plans.reports import REPORTS, Change, report
from metricloom.plans.snapshot import preview_snapshot, run_snapshot, run_snapshot_table
from metricloom.schemas import ENTITIES
from metricloom.session import job_session
from metricloom.sources.landing import fanout_keys, land_by_key
from metricloom.sources.tables import TableStore, read_table, write_table
from metricloom.sources.topics import Topic
from metricloom.streaming.compaction import TARGET_BYTES, compact, vacuum
from metricloom.streaming.new_keys import stream_new_keys

PASSWORD = "METRICLOOM_JDBC_PASSWORD"
PREVIEWS = {"consume": preview_consume, "snapshot": preview_snapshot, "dated": preview_dated}
TO_TOPIC = {"consume": run_consume, "snapshot": run_snapshot}
TO_TABLE = {"snapshot": run_snapshot_table, "dated": run_dated}


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="metricloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    def tables(job: argparse.ArgumentParser) -> None:
        job.add_argument("--tables", required=True, help="folder of tables, or a JDBC URL")
        job.add_argument("--jdbc", action="append", default=[], metavar="OPTION=VALUE")
        job.add_argument("--mode", default="errorifexists")

    cleanse = jobs.add_parser("cleanse", help="landed documents to a table")
    cleanse.add_argument("entity", choices=ENTITIES)
    cleanse.add_argument("--landing", required=True, help="folder or glob")
    cleanse.add_argument("--table")
    tables(cleanse)

    enrich = jobs.add_parser("enrich", help="a table to its enriched table")
    enrich.add_argument("entity", choices=tuple(ENRICH))
    enrich.add_argument("--table")
    enrich.add_argument("--target")
    tables(enrich)

    land = jobs.add_parser("land", help="a table to landed documents, a folder per key")
    land.add_argument("entity", choices=ENTITIES)
    land.add_argument("--landing", required=True, help="folder to write")
    land.add_argument("--table")
    land.add_argument("--key", required=True, help="column whose values name the folders")
    land.add_argument("--order-by", required=True, help="column that orders the items of a key")
    tables(land)

    fanout = jobs.add_parser("fanout", help="the distinct keys of a table, which drive the next pull")
    fanout.add_argument("--table", required=True)
    fanout.add_argument("--key", required=True)
    fanout.add_argument("--parent", help="keys per value of this column")
    fanout.add_argument("--target", required=True)
    fanout.add_argument("--checkpoint", help="only keys that no earlier run with this checkpoint gave out")
    tables(fanout)

    refreshing = jobs.add_parser("refresh", help="all report tables of an entity from one scan of its table")
    refreshing.add_argument("entity", choices=ENTITIES)
    refreshing.add_argument("--table")
    tables(refreshing)

    changes = jobs.add_parser("changes", help="daily sums and percent changes of the days that have new snapshots")
    changes.add_argument("name", choices=tuple(n for n, r in REPORTS.items() if isinstance(r, Change)))
    changes.add_argument("--table")
    changes.add_argument("--day", action="append", required=True, help="a day whose snapshots are new, as 2024-01-31")
    tables(changes)

    packing = jobs.add_parser("compact", help="pack the batches of a table that a stream fills")
    packing.add_argument("--table", required=True)
    packing.add_argument("--target-mb", type=int, default=TARGET_BYTES >> 20, help="size of the packed files")
    packing.add_argument("--partition-by", action="append", default=[], help="columns the table is partitioned by")
    packing.add_argument("--keep", type=int, help="remove what the last so many versions do not need")
    tables(packing)

    reports = jobs.add_parser("report", help="a table to a report table")
    reports.add_argument("name", choices=tuple(REPORTS))
    reports.add_argument("--table", required=True)
    reports.add_argument("--target", required=True)
    reports.add_argument("--column", action="append", default=[], metavar="REPORT_COLUMN=TABLE_COLUMN")
    tables(reports)

    for name in PREVIEWS:
        stream = jobs.add_parser(name, help="a message topic to its sink")
        stream.add_argument("entity", choices=ENTITIES)
        stream.add_argument("--servers", help="Kafka brokers; without them topics are folders")
        stream.add_argument("--topic", required=True)
        stream.add_argument("--source-option", action="append", default=[], metavar="OPTION=VALUE")
        stream.add_argument("--preview", action="store_true", help="print the rows instead")
        stream.add_argument("--checkpoint")
        stream.add_argument("--every", help="time between batches; without it the job ends when all is read")
        if name != "dated":
            stream.add_argument("--to", help="topic for the outgoing messages")
            stream.add_argument("--sink-option", action="append", default=[], metavar="OPTION=VALUE")
        if name != "consume":
            stream.add_argument("--tables", help="folder of tables, or a JDBC URL")
            stream.add_argument("--jdbc", action="append", default=[], metavar="OPTION=VALUE")
            stream.add_argument("--table")
    parsed = parser.parse_args(argv)
    if parsed.job in PREVIEWS and not parsed.preview:
        sinks = [o for o in ("to", "tables") if getattr(parsed, o, None) is not None]
        if len(sinks) != 1 or parsed.checkpoint is None:
            parser.error("needs one sink (--to or --tables) and --checkpoint, or --preview")
    return parsed


def pairs(options: Sequence[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


def store(args: argparse.Namespace) -> TableStore:
    options = pairs(args.jdbc)
    if args.tables.startswith("jdbc:") and PASSWORD in os.environ:
        options["password"] = os.environ[PASSWORD]
    return TableStore(args.tables, options)


def run_streaming(spark: SparkSession, args: argparse.Namespace) -> None:
    source = Topic(args.topic, args.servers, pairs(args.source_option))
    if args.preview:
        query = PREVIEWS[args.job](spark, args.entity, source, every=args.every)
    elif getattr(args, "tables", None) is not None:
        to_table = TO_TABLE[args.job]
        query = to_table(spark, args.entity, source, store(args), args.checkpoint, name=args.table, every=args.every)
    else:
        to_topic = TO_TOPIC[args.job]
        query = to_topic(spark, args.entity, source, Topic(args.to, args.servers, sink_options=pairs(args.sink_option)), args.checkpoint, every=args.every)
    query.awaitTermination()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = spark or job_session(f"metricloom {args.job}")
    if args.job == "cleanse":
        counts = run_cleanse(spark, args.entity, args.landing, store(args), args.table or args.entity, args.mode)
        print(counts)
    elif args.job == "enrich":
        name = args.table or args.entity
        run_enrich(spark, args.entity, store(args), store(args), name, args.target or f"{name}_enriched", args.mode)
    elif args.job == "land":
        rows = read_table(spark, store(args), args.table or args.entity)
        keyed = rows.select(rows[args.key].alias("folder"), rows[args.order_by].alias("row_key"), nested_item(rows, args.entity).alias("item"))
        land_by_key(keyed, args.landing, "folder", keyed["item"], "row_key")
    elif args.job == "fanout" and args.checkpoint is not None:
        stream_new_keys(spark, store(args), args.table, args.key, args.target, args.checkpoint, args.parent)
    elif args.job == "fanout":
        write_table(fanout_keys(read_table(spark, store(args), args.table), args.key, args.parent), store(args), args.target, args.mode)
    elif args.job == "refresh":
        for name, rows in refreshed(args.entity, read_table(spark, store(args), args.table or args.entity)).items():
            write_table(rows, store(args), f"{args.entity}_{name}", args.mode)
    elif args.job == "changes":
        print(update_changes(spark, store(args), store(args), args.name, args.day, args.table))
    elif args.job == "compact":
        path = store(args).path(args.table)
        print(compact(spark, path, args.target_mb << 20, args.partition_by))
        if args.keep is not None:
            vacuum(spark, path, args.keep)
    elif args.job == "report":
        rows = report(args.name, read_table(spark, store(args), args.table), **pairs(args.column))
        write_table(rows, store(args), args.target, args.mode)
    else:
        run_streaming(spark, args)


if __name__ == "__main__":
    main()
