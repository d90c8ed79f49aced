"""Run the streaming jobs: ``python -m tidepool <job> [options]`` (or through
``spark-submit``, which then decides the master).

Jobs, as in the reference: ``land`` (S4/J7), ``log`` (J1), ``uv`` (J2), ``cdc``
(J3), ``rules`` and ``route`` (J4), ``console`` (J6), ``topic-console`` (the
debug reader). Topics are folders under ``--root`` (the file stand-in); each job
can read its topic from Kafka (``--kafka``) and write to Kafka (``--kafka-out``).
Every job checkpoints under
``spark.checkpoint.dir`` unless ``--checkpoint`` is given, and runs until stopped
unless ``--trigger available-now`` (process what is there, then stop).
Hosts and credentials are options only.
"""

from __future__ import annotations

import argparse
import sys

ENVELOPE_SCHEMA = "arrival long, seq long, topic string, value string"


def _trigger(text: str) -> dict:
    if text == "available-now":
        return {"availableNow": True}
    return {"processingTime": text}


# The topic each job reads from Kafka unless --kafka-topic names another.
DEFAULT_TOPICS = {"log": "ods_base_log", "uv": "dwd_page_log", "route": "ods_base_db", "topic-console": "dwd_page_log"}


def _kafka(spark, args, with_topic: bool = False):
    """The job's Kafka source: its topic, group, start and trigger bound. Rules start
    from the earliest record, so that a new reader has the whole rule history."""
    from tidepool.sources import topics as T

    topic = args.kafka_topic or args.topic or DEFAULT_TOPICS.get(args.job)
    if not topic:
        raise SystemExit(f"{args.job}: --kafka-topic is needed with --kafka")
    starting = args.starting or ("earliest" if args.job == "rules" else "latest")
    return T.read_kafka(spark, topic, args.kafka, starting=starting, with_topic=with_topic, group=args.group,
                        options={"maxOffsetsPerTrigger": str(args.max_records)})


def _source(spark, args):
    """A topic source from Kafka, or None for the file topic."""
    return _kafka(spark, args) if args.kafka else None


def _history(spark, args):
    """The records handled before a stateful job's stream, from files of ``(arrival, seq, value)``, or None."""
    if not args.history:
        return None
    return (spark.read.schema("arrival long, seq long, value string").option("recursiveFileLookup", "true")
            .parquet(args.history))


def _sink(args):
    from tidepool.sources import topics as T

    return T.KafkaTopics(args.kafka_out) if args.kafka_out else T.FileTopics(args.root) if args.root else None


def _envelopes(spark, args):
    """Change envelopes ``(arrival, seq, topic, value)`` from Kafka or files, of the
    database and tables asked for, after an initial snapshot if one is given."""
    from tidepool.sources import changes as S

    if args.kafka:
        log = _kafka(spark, args, with_topic=True)
    else:
        log = (spark.readStream.schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", "true")
               .option("maxFilesPerTrigger", args.max_files).parquet(args.input))
    tables = args.tables.split(",") if args.tables else None
    log = S.only_tables(log, args.database, tables)
    if args.snapshot:
        database, _, table = args.snapshot_table.partition(".")
        snap = S.snapshot_stream(spark, args.snapshot, args.server, database, table, args.snapshot_key,
                                 args.snapshot_columns.split(","))
        log = S.change_source(log, snap, startup="initial")
    return log


def _handover_rows(spark, args):
    """The rows of a hand-over snapshot as raw envelopes, and the name of their table."""
    from pyspark.sql import functions as F

    from tidepool.sources import changes as S

    database, _, table = args.snapshot_table.partition(".")
    columns = args.snapshot_columns.split(",")
    rows = spark.read.parquet(f"{args.handover}/rows").select(
        F.col(args.snapshot_key).cast("long").alias("seq"), *[F.col(c).cast("string").alias(c) for c in columns])
    return S.snapshot_envelopes(rows, args.server, database, table, columns), table


def _store(spark, args):
    from tidepool.operators.dims import DimStore

    return DimStore(spark, args.dims_path, database=args.dims_db, buckets=args.dims_buckets)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tidepool", description=__doc__.split("\n\n")[0])
    p.add_argument("job", choices=["land", "log", "uv", "cdc", "rules", "route", "console",
                                   "topic-console"])
    p.add_argument("--root", help="folder of topics (file stand-in)")
    p.add_argument("--input", help="folder of change-envelope parquet files (cdc, rules, console)")
    p.add_argument("--incoming", help="folder of received log lines (land)")
    p.add_argument("--landing", help="folder of daily log files (land)")
    p.add_argument("--topic", help="topic to print (topic-console)")
    p.add_argument("--kafka", help="Kafka bootstrap servers; read the source from Kafka")
    p.add_argument("--kafka-topic", help="Kafka topic to read (default: the job's own topic)")
    p.add_argument("--kafka-out", help="Kafka bootstrap servers; write all topics to Kafka")
    p.add_argument("--group", help="Kafka consumer group")
    p.add_argument("--starting", choices=["latest", "earliest"],
                   help="where a new Kafka reader starts (default: latest, for rules earliest)")
    p.add_argument("--max-records", type=int, default=5_000_000, help="Kafka records per micro-batch")
    p.add_argument("--max-files", type=int, default=64, help="files per micro-batch of a file source")
    p.add_argument("--history", help="parquet folder of the records handled before this job's stream (log, uv): "
                                     "its state on a new checkpoint")
    p.add_argument("--handover", help="folder of a snapshot taken by operators.handover.record_ranges while changes went "
                                      "on; its table is --snapshot-table (cdc)")
    p.add_argument("--range-width", type=int, default=1 << 16, help="keys of a range of the --handover snapshot")
    p.add_argument("--database", help="changes of this database only (cdc, rules, console)")
    p.add_argument("--tables", help="comma-separated tables; changes of others are left out")
    p.add_argument("--snapshot", help="parquet folder of a table to read first, as its initial snapshot")
    p.add_argument("--snapshot-table", help="database.table of the snapshot")
    p.add_argument("--snapshot-key", default="id", help="numeric primary key of the snapshot")
    p.add_argument("--snapshot-columns", help="comma-separated columns of the snapshot")
    p.add_argument("--server", default="server", help="first part of the snapshot's topic name")
    p.add_argument("--rule-table", default="table_process", help="name of the rule table (rules)")
    p.add_argument("--compact-every", type=int, default=100,
                   help="fold the dimension store every so many batches (route; 0: never)")
    p.add_argument("--print-to", help="folder of the printed records (console, topic-console)")
    p.add_argument("--dims-path", help="folder of the dimension cell store (rules, route)")
    p.add_argument("--dims-db", default="dims", help="catalog database of the dimensions")
    p.add_argument("--dims-buckets", type=int, default=16,
                   help="buckets of row keys a dimension is cut into; a fold rewrites those with new cells")
    p.add_argument("--ttl", action="store_true", help="24 h expiry of unique-visit state (W3)")
    p.add_argument("--honour-sink-pk", action="store_true",
                   help="key dimension rows by the rule's sink_pk instead of id")
    p.add_argument("--latest-rules", action="store_true",
                   help="route by the latest rules instead of the rules in force at arrival")
    p.add_argument("--batch-gb", type=float, help="gigabytes that a micro-batch reads; sizes the partitions (session.scale_conf)")
    p.add_argument("--cores", type=int, default=0, help="task slots of the cluster, for --batch-gb (default: what the session has)")
    p.add_argument("--trigger", default="10 seconds",
                   help="'available-now' or a processing-time interval such as '10 seconds'")
    p.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    return p


def main(argv: list[str] | None = None, spark=None):
    """Start the job; wait for it unless ``spark`` is given (tests), in which case
    the started query is returned."""
    args = build_parser().parse_args(argv)
    from tidepool.session import checkpoint_root, get_session, scale_conf
    from tidepool.streaming import jobs as SJ

    own = spark is None
    spark = spark or get_session(app_name=f"tidepool-{args.job}")
    if args.batch_gb:
        for key, value in scale_conf(int(args.batch_gb * (1 << 30)), args.cores or spark.sparkContext.defaultParallelism).items():
            spark.conf.set(key, value)
    checkpoint_root(spark)
    trig = _trigger(args.trigger)
    ck = args.checkpoint
    sink = _sink(args)
    if args.job == "land":
        q = SJ.start_landing_job(spark, args.incoming, args.root, args.landing, trig, ck, sink=sink,
                                 max_files_per_trigger=args.max_files)
    elif args.job == "log":
        q = SJ.start_log_job(spark, args.root, trig, ck, max_files_per_trigger=args.max_files,
                             source=_source(spark, args), sink=sink, history=_history(spark, args))
    elif args.job == "uv":
        q = SJ.start_uv_job(spark, args.root, trig, ck, ttl=args.ttl, max_files_per_trigger=args.max_files,
                            source=_source(spark, args), sink=sink, history=_history(spark, args))
    elif args.job == "cdc" and args.handover:
        from tidepool.operators import handover as H

        rows, table = _handover_rows(spark, args)
        q = SJ.start_handover_job(spark, args.root, rows, H.ranges_of(spark, args.handover), _envelopes(spark, args), table,
                                  key=args.snapshot_key, width=args.range_width, trigger=trig, checkpoint=ck, sink=sink)
    elif args.job == "cdc":
        q = SJ.start_cdc_job(spark, args.root, _envelopes(spark, args), trig, ck, sink=sink)
    elif args.job == "rules":
        dims = _store(spark, args) if args.dims_path else None
        q = SJ.start_rule_job(spark, args.root, _envelopes(spark, args), trig, ck, dims=dims,
                              rule_table=args.rule_table, honour_sink_pk=args.honour_sink_pk, sink=sink)
    elif args.job == "route":
        q = SJ.start_route_job(spark, args.root, _store(spark, args), changes=_source(spark, args), trigger=trig,
                               checkpoint=ck, asof=not args.latest_rules, honour_sink_pk=args.honour_sink_pk,
                               sink=sink, compact_every=args.compact_every, max_files_per_trigger=args.max_files)
    elif args.job == "console":
        q = SJ.start_console_job(spark, _envelopes(spark, args), trig, ck, out=args.print_to)
    else:
        q = SJ.start_topic_console(spark, args.root, args.topic, trig, ck, out=args.print_to,
                                   source=_source(spark, args), max_files_per_trigger=args.max_files)
    if not own:
        return q
    q.awaitTermination()
    return None


if __name__ == "__main__":
    sys.exit(main())
