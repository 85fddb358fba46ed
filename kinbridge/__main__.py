"""Command line: python -m kinbridge load|kpi|sql|counts|replay ...

Submit with ``spark-submit`` to run on a cluster; sizes and the shared
``spark.checkpoint.dir`` come from the submitted configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from kinbridge.contracts import FACT_ACTIVITY
from kinbridge.options import COMPAT, STRICT
from kinbridge.plans import kpis
from kinbridge.plans.run import run
from kinbridge.session import configure
from kinbridge.sinks import warehouse
from kinbridge.sources import replay, sources_from_folder, sources_from_manifest
from kinbridge.sources.manifest import fee_limits, read_manifest, tenant_rules


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinbridge")
    commands = top.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="load NDJSON sources into the warehouse")
    given = load.add_mutually_exclusive_group(required=True)
    given.add_argument("--input", help="folder with <source>.json files or folders")
    given.add_argument("--manifest", help="tenant manifest")
    load.add_argument("--warehouse", required=True)
    load.add_argument("--compat", action="store_true", help="historic semantics")
    load.add_argument("--append-all", action="store_true", help="store known rows again")

    for name, about in (
        ("kpi", "print the three KPIs"),
        ("counts", "print current rows per table"),
        ("sql", "run SQL on the current tables"),
    ):
        command = commands.add_parser(name, help=about)
        command.add_argument("--warehouse", required=True)
        command.add_argument("--compat", action="store_true", help="historic semantics")
        _add_output(command)
        if name == "sql":
            command.add_argument("statement")

    messages = commands.add_parser("replay", help="turn files into messages per topic")
    messages.add_argument("--input", required=True)
    messages.add_argument("--target", help="folder that gets one folder per topic")
    messages.add_argument("--kafka", help="bootstrap servers")
    _add_output(messages)
    return top


def _add_output(command: argparse.ArgumentParser) -> None:
    given = command.add_mutually_exclusive_group()
    given.add_argument("--output", help="folder for the whole result as Parquet")
    given.add_argument("--preview", type=int, help="print so many rows only")


def _deliver(args: argparse.Namespace, result: DataFrame, name: str = "") -> None:
    """Writes or prints the whole result; only ``--preview`` cuts it.

    Printed rows come from one partition at a time.
    """
    if args.output:
        result.write.mode("overwrite").parquet(f"{args.output}/{name}".rstrip("/"))
    elif args.preview is not None:
        result.show(args.preview, truncate=False)
    else:
        print("|".join(result.columns))
        for row in result.toLocalIterator():
            print("|".join(map(str, row)))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("kinbridge").getOrCreate())

    sem = COMPAT if getattr(args, "compat", False) else STRICT

    if args.command == "load":
        limits = rules = None
        if args.manifest:
            entries = read_manifest(spark, args.manifest)
            sources, limits = sources_from_manifest(spark, entries), fee_limits(spark, entries)
            rules = tenant_rules(spark, entries)
        else:
            sources = sources_from_folder(spark, args.input)
        report = run(
            spark,
            sources,
            args.warehouse,
            sem,
            fee_limits=limits,
            rules=rules,
            only_new=not args.append_all,
        )
        print("read", report.rows, "rejected", report.rejected)
    elif args.command == "kpi":
        facts = warehouse.read_current(
            spark, args.warehouse, FACT_ACTIVITY, by_natural_key=sem.replace_by_natural_key
        )
        for kpi in (kpis.fee_by_tenant, kpis.top_customers, kpis.daily_active_customers):
            _deliver(args, kpi(facts), kpi.__name__)
    elif args.command == "counts":
        _deliver(args, warehouse.row_counts(spark, args.warehouse, sem))
    elif args.command == "sql":
        warehouse.register_views(spark, args.warehouse, sem)
        _deliver(args, spark.sql(args.statement))
    else:
        found = replay.messages(spark, args.input)
        if args.target:
            replay.publish_to_folder(found, args.target)
        if args.kafka:
            replay.publish_to_kafka(found, args.kafka)
        _deliver(args, replay.topic_counts(found))


if __name__ == "__main__":
    main()
