"""Jobs for spark-submit: ``python -m txnlens <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from txnlens.functions import messages as msg
from txnlens.ml import train as tr
from txnlens.ml.score import scored
from txnlens.plans.daily import run_daily
from txnlens.schemas import FRAUD_RESULT_MESSAGE, SCORING_NAMES, STORED_RESULTS, STORED_TRANSACTIONS
from txnlens.session import scratch_of_a_job, session
from txnlens.sinks.daily import land
from txnlens.sinks.metadata import model_path
from txnlens.sinks.upsert import KeyedTable
from txnlens.sources import streams
from txnlens.sources.files import landing_path, read_first_existing, read_json_records
from txnlens.streaming import jobs

def landing(spark: SparkSession, args: argparse.Namespace) -> None:
    """Land fetched JSON records as the CSV of a day."""
    land(read_json_records(spark, args.records), f"{args.base}/transactions", args.ds)


def _raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The given file if there is one, else what was landed for the day."""
    landed = landing_path(f"{args.base}/transactions", args.ds)
    return read_first_existing(spark, [*([args.source] if args.source else []), landed])


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    """Build the star schema of a day."""
    run_daily(spark, _raw(spark, args), f"{args.base}/datalake", args.ds)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Train, compare and store the classifiers, unless a model exists."""
    base = f"{args.base}/model"

    def run() -> None:
        tr.train_and_store(_raw(spark, args), base, args.ds, dated=False, hashed=args.hashed)

    if args.again:
        run()
    else:
        tr.train_if_absent(spark, base, run)


def _messages(spark: SparkSession, args: argparse.Namespace, topics: list[str]) -> DataFrame:
    if args.servers:
        return streams.broker_stream(spark, args.servers, topics, args.starting)
    return streams.file_stream(spark, args.inbox)


def _emit(results: DataFrame, args: argparse.Namespace) -> None:
    trigger = {"processingTime": args.every} if args.every else {}
    if args.servers:
        checkpoint = f"{args.out}/checkpoint"
        query = jobs.to_broker(results, args.servers, streams.FRAUD_TOPIC, checkpoint, **trigger)
    else:
        query = jobs.to_files(results, args.out, "results", **trigger)
    query.awaitTermination()


def detect(spark: SparkSession, args: argparse.Namespace) -> None:
    """Turn valid transaction messages into result messages."""
    _emit(jobs.detected(_messages(spark, args, [streams.TRANSACTION_TOPIC])), args)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    """Score transaction messages with the stored model."""
    base = f"{args.base}/model"
    fitted = tr.load_preprocessor(base)
    path = model_path(base, args.model)
    model = tr.load_with_retry(lambda: tr.MODELS[args.model].load(path))
    judged = msg.with_reason(
        msg.decode(_messages(spark, args, [streams.TRANSACTION_TOPIC])), labelled=False
    )
    results = scored(msg.valid(judged, SCORING_NAMES), fitted, model)
    _emit(results.select(*FRAUD_RESULT_MESSAGE.names), args)


def persist(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store both topics in their keyed tables."""
    topics = [streams.TRANSACTION_TOPIC, streams.FRAUD_TOPIC]
    jobs.persist_topics(
        _messages(spark, args, topics),
        KeyedTable(f"{args.out}/transactions", STORED_TRANSACTIONS, "transaction_id", "transaction_date", args.period, args.buckets),
        KeyedTable(f"{args.out}/fraud_results", STORED_RESULTS, "transaction_id", "timestamp", args.period, args.buckets),
        f"{args.out}/rejected",
        args.out,
        "persist",
        **({"processingTime": args.every} if args.every else {}),
    ).awaitTermination()


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="txnlens")
    sub = parser.add_subparsers(required=True)

    def add(job, *options: tuple[str, dict]) -> None:
        command = sub.add_parser(job.__name__, help=job.__doc__)
        for name, settings in options:
            command.add_argument(name, **settings)
        command.set_defaults(job=job)

    needed = {"required": True}
    base, ds, source = ("--base", needed), ("--ds", needed), ("--source", {})
    stream = [
        ("--servers", {"help": "broker addresses; without them messages are files"}),
        ("--inbox", {"help": "folder of message files"}),
        ("--starting", {"default": "latest"}),
        ("--every", {"help": "interval between batches; without it the job ends when done"}),
        ("--out", needed),
    ]
    add(landing, base, ds, ("--records", needed))
    add(daily, base, ds, source)
    hashed = {"nargs": "*", "default": [], "help": "categorical columns too wide for a vocabulary"}
    add(train, base, ds, source, ("--again", {"action": "store_true"}), ("--hashed", hashed))
    add(detect, *stream)
    add(score, base, ("--model", {"default": "Gradient-Boosted Trees", "choices": list(tr.MODELS)}), *stream)
    buckets = {"type": int, "default": 8, "help": "hash buckets of each period's partition"}
    add(persist, *stream, ("--period", {"default": "day"}), ("--buckets", buckets))
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = session(f"txnlens-{args.job.__name__}")
    with scratch_of_a_job(spark):
        args.job(spark, args)


if __name__ == "__main__":
    main()
