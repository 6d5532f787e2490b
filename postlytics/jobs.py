"""Jobs with arguments: `python -m postlytics.jobs {ingest,stream,view,mend,train} ..`.

Streams run for a number of minutes, or over what is there now with `--once`. Formats and
connector options are given as `--format` and repeated `--option name=value`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter

from postlytics.operators.tags import TagList
from postlytics.plans.training import train_and_shrink
from postlytics.session import build_session
from postlytics.settings import DEFAULTS
from postlytics.sources.batches import write_batch
from postlytics.sources.seeds import read_seeds
from postlytics.sources.streams import read_messages, write_messages
from postlytics.streaming import control
from postlytics.streaming.ingest import ingest, read_statuses
from postlytics.streaming.pipeline import Pipeline, TopicModel
from postlytics.streaming.view import mend_view, minute_view, read_assigned, view_writer


def _run(writer: DataStreamWriter, args: argparse.Namespace) -> None:
    query = control.start(writer, once=args.once)
    if args.once:
        control.finish(query)
    else:
        control.run_for(query, args.minutes)


def _seeds(spark: SparkSession, args: argparse.Namespace) -> TagList:
    return TagList.required(read_seeds(spark, args.seeds))


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed statuses, filtered, to messages."""
    messages = ingest(read_statuses(spark, args.statuses), _seeds(spark, args))
    _run(write_messages(messages, args.checkpoint, args.format, args.out, **args.option), args)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Messages to accepted, cleaned and scored posts below the root."""
    job = Pipeline(args.root, _seeds(spark, args), TopicModel(args.model))
    _run(job.writer(read_messages(spark, args.format, args.messages, **args.option)), args)


def run_view(spark: SparkSession, args: argparse.Namespace) -> None:
    """Assigned posts below the root to the minute view."""
    view = minute_view(read_assigned(spark, f"{args.root}/assigned"))
    _run(view_writer(view, lambda rows, batch_id: write_batch(rows, args.out, batch_id), args.checkpoint), args)


def run_mend(spark: SparkSession, args: argparse.Namespace) -> None:
    """Posts that came too late for the minute view to corrections beside it."""
    mend_view(spark, f"{args.root}/assigned", args.out)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    """The corpus below the root to a new model version, then retention."""
    train_and_shrink(spark, args.root, args.model, args.seed)


def _option(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="postlytics", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *needed: str, stream: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for argument in needed:
            sub.add_argument(f"--{argument}", required=True)
        if stream:
            sub.add_argument("--minutes", type=float, default=DEFAULTS.run_minutes)
            sub.add_argument("--once", action="store_true")
        return sub

    def connector(sub: argparse.ArgumentParser, place: str) -> None:
        sub.add_argument("--format", default="kafka")
        sub.add_argument(f"--{place}", help="a path, for file formats")
        sub.add_argument("--option", type=_option, action="append", default=[], metavar="NAME=VALUE")

    connector(job("ingest", run_ingest, "statuses", "seeds", "checkpoint"), "out")
    connector(job("stream", run_stream, "root", "seeds", "model"), "messages")
    job("view", run_view, "root", "out", "checkpoint")
    job("mend", run_mend, "root", "out", stream=False)
    job("train", run_train, "root", "model", stream=False).add_argument("--seed", type=int, default=1)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    if hasattr(args, "option"):
        args.option = dict(args.option)
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
