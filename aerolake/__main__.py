"""Command-line entry point (``python -m aerolake`` or ``spark-submit aerolake/__main__.py``).

    run     one live run: Bronze file(s) -> Silver -> Gold (+ publish)
    replay  rebuild Silver and Gold from all of Bronze (+ publish)
    stream  incremental Bronze -> Silver over new files only

Publishing goes to Parquet serving tables (``--serving``) or to a JDBC
database (``--jdbc-url``).  The session comes from ``spark-submit``'s settings.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from aerolake.contracts import SERVING_CONTRACTS
from aerolake.plans.pipeline import (
    LakePaths,
    process_bronze,
    publish_serving,
    written_silver,
)
from aerolake.streaming.incremental import incremental_silver


def _formats(s: argparse.ArgumentParser) -> None:
    one = s.add_mutually_exclusive_group()
    one.add_argument("--multi-line", action="store_const", const=True, dest="multi_line", help="each file is one document; default: told per file")
    one.add_argument("--lines", action="store_const", const=False, dest="multi_line", help="each line is a document")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerolake", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)
    helps = {
        "run": "one live run: Bronze file(s) -> Silver -> Gold (+ publish this run)",
        "replay": "rebuild Silver and Gold from all of Bronze (+ publish the last-run-wins fold)",
    }
    for name in ("run", "replay"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("--bronze", required=True, help="Bronze file, directory or root")
        s.add_argument("--lake", required=True, help="lake root for Silver and Gold")
        s.add_argument("--zone", default="UTC", help="local zone of Bronze directory names")
        _formats(s)
        s.add_argument("--serving", help="root of the Parquet serving tables to upsert into")
        s.add_argument("--jdbc-url", help="JDBC URL of the serving database")
        s.add_argument("--jdbc-user")
        s.add_argument("--jdbc-password")
        s.add_argument("--jdbc-driver")
        s.add_argument("--round", type=int, default=None, help="round averages to N digits")
        if name == "run":
            s.add_argument("--record-epoch", type=int, help="run instant (epoch s); default now")
    s = sub.add_parser("stream", help="incremental Bronze -> Silver (-> Gold -> serving) over new files")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--zone", default="UTC")
    _formats(s)
    s.add_argument("--rejects", help="rejected states go here, with the reason")
    s.add_argument("--runs", help="table of what was read and kept of each run")
    s.add_argument("--quarantine", help="documents that cannot be parsed go here; without it they fail the stream")
    s.add_argument("--processing-time", help="keep running with this trigger instead of availableNow")
    s.add_argument("--gold-positions", help="also append Gold positions here")
    s.add_argument("--gold-metrics", help="also append Gold metrics here")
    s.add_argument("--serving", help="also upsert each batch into these serving tables")
    s.add_argument("--round", type=int, default=None)
    return p


def _publish(spark, args, lake: LakePaths, record_epoch: int | None) -> dict:
    out: dict = {}
    if args.serving:
        out["serving"] = publish_serving(
            spark, lake, args.serving, record_epoch=record_epoch, round_digits=args.round
        )
    if args.jdbc_url:
        from aerolake.operators.gold import country_metrics
        from aerolake.operators.upsert import fold_latest
        from aerolake.sinks.jdbc import publish_gold

        silver = written_silver(spark, lake, record_epoch)
        c = SERVING_CONTRACTS
        positions = fold_latest(silver, c["gold_flight_positions"].keys,
                                ["ingested_at", "source_file_path"], c["gold_flight_positions"].columns)
        metrics = fold_latest(country_metrics(silver, keep_run=True, round_digits=args.round),
                              c["gold_country_metrics"].keys, ["ingested_at"],
                              c["gold_country_metrics"].columns)
        props = {k: v for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password),
                                   ("driver", args.jdbc_driver)) if v}
        out["jdbc"] = publish_gold(spark, positions, metrics, args.jdbc_url, props)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("aerolake").getOrCreate()
    if args.command == "stream":
        q = incremental_silver(
            spark, args.bronze, args.silver, args.checkpoint, zone=args.zone, multi_line=args.multi_line,
            available_now=args.processing_time is None, processing_time=args.processing_time,
            gold_positions_path=args.gold_positions, gold_metrics_path=args.gold_metrics,
            serving_root=args.serving, quarantine_path=args.quarantine, rejects_path=args.rejects, runs_path=args.runs,
            round_digits=args.round,
        )
        q.awaitTermination()
        return {"command": "stream", "silver": args.silver}
    lake = LakePaths.under(args.lake)
    epoch = None
    if args.command == "run":
        epoch = args.record_epoch if args.record_epoch is not None else int(time.time())
    bronze = process_bronze(
        spark, args.bronze, lake, record_epoch=epoch, zone=args.zone,
        multi_line=args.multi_line, rebuild=args.command == "replay", round_digits=args.round,
    )
    result = {"command": args.command, "lake": args.lake, "bronze": bronze, **_publish(spark, args, lake, epoch)}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
