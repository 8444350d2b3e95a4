"""Jobs for spark-submit: python -m playlake <job> --help"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from playlake import fixed
from playlake.operators import counts
from playlake.plans.batch import run_batch
from playlake.plans.incremental import run_incremental
from playlake.plans.serving import load_catalog, run_serving
from playlake.session import prepare, size_for
from playlake.sources import files, messages
from playlake.streaming import plays as stream
from playlake.streaming.plays import BATCH_FOLDERS


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Ingest, windows and level summary, until one of them ends."""
    events = stream.parsed_events(messages.kafka_messages(spark, args.servers, args.topic))
    checkpoint = args.checkpoint
    queries = [
        stream.start_ingest(events, args.raw, args.speed, f"{checkpoint}/ingest", args.every),
        stream.start_window(events, args.window, f"{checkpoint}/window", args.every),
        stream.start_level_summary(events, f"{checkpoint}/levels"),
    ]
    stream.run_until_stopped(spark, queries)


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    written = run_batch(spark, args.raw, args.store, not args.no_models, args.input_bytes)
    for name, rows in written.items():
        print(f"{name}: {rows} rows")


def serve(spark: SparkSession, args: argparse.Namespace) -> None:
    size_for(spark, files.stored_bytes(spark, f"{args.store}/clean"))
    written = run_serving(spark, args.store, args.speed, args.export, args.overlap)
    for name, rows in written.items():
        print(f"{name}: " + ("not in the store, skipped" if rows is None else f"{rows} rows"))


def catalog(spark: SparkSession, args: argparse.Namespace) -> None:
    size_for(spark, files.stored_bytes(spark, args.clean))
    folders = None if args.flat_speed else BATCH_FOLDERS
    load_catalog(spark, args.database, args.clean, args.speed, args.location, folders)


def by_day(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bring the tables by day up to what has landed."""
    size_for(spark, files.stored_bytes(spark, args.raw))
    for name, rows in run_incremental(spark, args.raw, args.store).items():
        print(f"{name}: {rows}")


def nightly(spark: SparkSession, args: argparse.Namespace) -> None:
    """All steps of a night in their order: batch run, catalog, then the export, by the batch run's mark."""
    batch(spark, args)
    args.clean = f"{args.store}/clean"
    catalog(spark, args)
    serve(spark, args)


def export_json(spark: SparkSession, args: argparse.Namespace) -> None:
    size_for(spark, files.stored_bytes(spark, args.clean))
    files.write_json(files.read_events(spark, args.clean), args.json)


def keyed_counts(spark: SparkSession, args: argparse.Namespace) -> None:
    """The three counts in both forms: with null groups, and by text key."""
    size_for(spark, files.stored_bytes(spark, args.json))
    events = files.read_json_events(spark, args.json)
    views = {
        "top_artists": counts.bench_top_artists(events),
        "plays_by_hour": counts.bench_plays_by_hour(events),
        "user_sessions": counts.bench_user_sessions(events),
        "artist_keys": counts.count_by_artist_key(events),
        "hour_keys": counts.count_by_hour_key(events),
        "user_keys": counts.count_by_user_key(events),
    }
    for name, view in views.items():
        files.write_parquet(view, f"{args.out}/{name}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="playlake")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=run.__doc__)
        for option in required:
            sub.add_argument(option, required=True)
        sub.set_defaults(run=run)
        return sub

    streaming = job(
        "stream", run_stream, "--servers", "--raw", "--speed", "--window", "--checkpoint"
    )
    streaming.add_argument("--topic", default=fixed.TOPIC)
    streaming.add_argument("--every", default=fixed.SINK_TRIGGER)
    batching = job("batch", batch, "--raw", "--store")
    batching.add_argument("--no-models", action="store_true")
    batching.add_argument("--input-bytes", type=int)
    serving = job("serve", serve, "--store", "--speed", "--export")
    serving.add_argument("--overlap", action="store_true")
    tables = job("catalog", catalog, "--database", "--clean")
    tables.add_argument("--speed")
    tables.add_argument("--location")
    tables.add_argument("--flat-speed", action="store_true")
    job("by-day", by_day, "--raw", "--store")
    whole = job("nightly", nightly, "--raw", "--store", "--speed", "--export", "--database")
    whole.add_argument("--no-models", action="store_true")
    whole.add_argument("--input-bytes", type=int)
    whole.add_argument("--overlap", action="store_true")
    whole.add_argument("--location")
    whole.add_argument("--flat-speed", action="store_true")
    job("export-json", export_json, "--clean", "--json")
    job("counts", keyed_counts, "--json", "--out")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = prepare(SparkSession.builder.appName("playlake").getOrCreate())
    args.run(spark, args)


if __name__ == "__main__":
    main()
