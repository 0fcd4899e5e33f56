"""The jobs on the command line, for spark-submit and a scheduler of choice."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from editpulse.config import Settings
from editpulse.plans.replay import run_replay
from editpulse.plans.upkeep import run_upkeep
from editpulse.session import build_session
from editpulse.sources.feed import read_feed
from editpulse.sources.frames import read_frames
from editpulse.sources.lake import Lake, create_tables, sync_partitions
from editpulse.sources.topic import kafka_options, topic_stream
from editpulse.streaming import layers, service


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="editpulse", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, topic: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the lake")
        sub.add_argument("--database", help="catalog database over the lake")
        sub.add_argument("--format", default="parquet", help="table format; others than parquet need a database")
        if topic:
            sub.add_argument("--servers", help="Kafka bootstrap servers")
            sub.add_argument("--topic", default="edits.raw")
            sub.add_argument("--topic-path", help="file form of the topic, in place of Kafka")
            sub.add_argument("--once", action="store_true", help="take what is there and end")
        return sub

    job("init", "create database and tables")
    publish = job("publish", "captured feed lines to the topic", topic=True)
    publish.add_argument("--feed", required=True, help="folder of the captured feed")
    publish.add_argument("--feed-shape", choices=("json", "frames"), default="json", help="lines as JSON, or raw event-stream text")
    stream = job("stream", "topic to Bronze, Silver and Gold", topic=True)
    stream.add_argument("--interval", default="10 seconds")
    stream.add_argument("--silver-files", type=int, help="Silver files per batch and day")
    stream.add_argument("--watermark", default=Settings.watermark, help="late tolerance of Gold")
    stream.add_argument("--dedup-horizon", help="how long Silver remembers an id, e.g. '24 hours'; for ever without")
    stream.add_argument("--dedup-splits", type=int, default=Settings.dedup_splits)
    stream.add_argument("--starting-offsets", default=Settings.starting_offsets)
    stream.add_argument("--fail-on-data-loss", action="store_true")
    replay = job("replay", "correct late data of the last hours")
    replay.add_argument("--lookback-hours", type=int, default=Settings.lookback_hours)
    upkeep = job("upkeep", "orphans and compaction")
    upkeep.add_argument("--delete-orphans", action="store_true")
    upkeep.add_argument("--cluster-pages", action="store_true", help="lay compacted edits out by time and page")
    upkeep.add_argument("--orphan-hours", type=int, default=Settings.orphan_hours)
    for sub in (stream, replay):
        sub.add_argument("--user-shape", choices=("struct", "feed"), default="struct")
    return parser


def _source(spark: SparkSession, args: argparse.Namespace):
    if args.topic_path:
        return topic_stream(spark, path=args.topic_path)
    settings = Settings(starting_offsets=args.starting_offsets, fail_on_data_loss=args.fail_on_data_loss)
    return topic_stream(spark, "kafka", options=kafka_options(args.servers, args.topic, settings))


def _publish(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    trigger = layers.ONCE if args.once else None
    read = read_frames if args.feed_shape == "frames" else read_feed
    lines, checkpoint = read(spark, args.feed, stream=True), lake.checkpoint("publish")
    if args.topic_path:
        target = {"path": args.topic_path, "topic": args.topic}
    else:
        target = {
            "fmt": "kafka",
            "kafka.bootstrap.servers": args.servers,
            "topic": args.topic,
            "kafka.acks": "all",
        }
    layers.start_publish(lines, checkpoint, trigger=trigger, **target).awaitTermination()


def _stream(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    topic = _source(spark, args)
    settings = Settings(
        silver_files=args.silver_files,
        watermark=args.watermark,
        dedup_horizon=args.dedup_horizon,
        dedup_splits=args.dedup_splits,
    )
    if args.once:
        service.drain(spark, lake, topic, settings, shape=args.user_shape)
    else:
        service.serve(spark, lake, topic, settings, args.interval, args.user_shape)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark, lake = build_session(f"editpulse-{args.job}"), Lake(args.root, args.format, args.database)
    if args.database:
        create_tables(spark, lake, args.database)
    if args.job == "publish":
        _publish(spark, lake, args)
    elif args.job == "stream":
        _stream(spark, lake, args)
    elif args.job == "replay":
        settings = Settings(lookback_hours=args.lookback_hours)
        print(run_replay(spark, lake, settings=settings, shape=args.user_shape))
    elif args.job == "upkeep":
        print(
            run_upkeep(
                spark,
                lake,
                delete=args.delete_orphans,
                orphan_hours=args.orphan_hours,
                cluster_pages=args.cluster_pages,
            )
        )
    if args.database:
        sync_partitions(spark, lake, args.database)


if __name__ == "__main__":
    main()
