"""Command line.

    python -m ratemill build-store --store DIR --seeds DIR [--buckets N]
    python -m ratemill load-rules  --store DIR --rules CSV [--load-id ID]
    python -m ratemill check       --store DIR
    python -m ratemill sheet       --store DIR --billing CSV --out DIR [--variant V] ...
    python -m ratemill prototype   --rules CSV --billing CSV --out DIR
    python -m ratemill rated-lines --rules CSV --billing CSV --out DIR
    python -m ratemill synth       --rows N --clients N --out DIR

``--billing`` also takes parquet (a path that ends in ``.parquet``).
Lines of a CSV that cannot be read are not billed; they are written, with the reason, to
``--rejects DIR`` (the output folder with ``-rejects``, if not given).
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .operators import refdata, synth
from .plans import sheet as plans
from .session import build_session
from .sources import csvfiles, reference

VARIANTS = {
    "normalised": plans.billing_sheet,
    "text-keys": plans.billing_sheet_text_keys,
    "strict": plans.billing_sheet_strict,
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ratemill")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    command("build-store", "store", "seeds").add_argument("--buckets", type=int)
    command("load-rules", "store", "rules").add_argument("--load-id")
    command("check", "store")
    for sub in (
        command("sheet", "store", "billing", "out"),
        command("prototype", "rules", "billing", "out"),
        command("rated-lines", "rules", "billing", "out"),
    ):
        sub.add_argument("--period-end", type=date.fromisoformat)
        sub.add_argument("--flagged-state")
        sub.add_argument("--rejects")
    commands.choices["sheet"].add_argument("--variant", choices=VARIANTS, default="normalised")
    sub = command("synth", "out")
    sub.add_argument("--rows", type=int, default=200)
    sub.add_argument("--clients", type=int, default=5)
    return parser


def _options(args: argparse.Namespace) -> plans.SheetOptions:
    given = {"period_end": args.period_end, "flagged_state": args.flagged_state}
    return plans.SheetOptions(**{k: v for k, v in given.items() if v is not None})


def _billing(
    spark: SparkSession, args: argparse.Namespace, numbered: bool = False
) -> DataFrame:
    if args.billing.rstrip("/").endswith(".parquet"):
        return csvfiles.read_billing_parquet(spark, args.billing, numbered)
    rejects = args.rejects or f"{args.out.rstrip('/')}-rejects"
    lines = csvfiles.read_billing(spark, args.billing, rejects=rejects, numbered=numbered)
    rejected = csvfiles.read_rejects(spark, rejects).count()
    if rejected:
        print(f"{rejected} lines with unreadable fields, units or dates are in {rejects}")
    return lines


def _check(spark: SparkSession, store: str) -> list[tuple[str, DataFrame]]:
    commit = reference.current(spark, store)
    return refdata.check_reference(
        {n: reference.read_folders(spark, n, commit.tables[n], commit.buckets) for n in reference.TABLES}
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or build_session()
    if args.command == "build-store":
        seeds = {
            name: csvfiles.read_seed(spark, f"{args.seeds}/{name}.csv", schema)
            for name, schema in reference.TABLES.items()
        }
        refdata.build_reference_store(spark, args.store, seeds, buckets=args.buckets)
    elif args.command == "load-rules":
        rules = csvfiles.read_rules(spark, args.rules).withColumnRenamed("rule_id", "seq")
        if not refdata.load_rules(spark, args.store, rules, load_id=args.load_id):
            print(f"load {args.load_id} has been made before")
    elif args.command == "check":
        for title, rows in _check(spark, args.store):
            print(title, rows.count())
            rows.show(10, truncate=False)
    elif args.command == "sheet":
        tables = reference.read_reference(spark, args.store)
        sheet = VARIANTS[args.variant](_billing(spark, args), tables, _options(args))
        csvfiles.write_csv(plans.in_sheet_order(sheet), args.out, schemas.SHEET_HEADER)
    elif args.command == "prototype":
        rules = csvfiles.read_rules(spark, args.rules)
        sheet = plans.upload_prototype(_billing(spark, args), rules, _options(args))
        csvfiles.write_csv(plans.in_sheet_order(sheet), args.out, schemas.PROTOTYPE_HEADER)
    elif args.command == "rated-lines":
        rules = csvfiles.read_rules(spark, args.rules)
        lines = plans.rated_lines(_billing(spark, args, numbered=True), rules, _options(args))
        if csvfiles.LINE_NUMBER in lines.columns:
            lines = lines.orderBy(csvfiles.LINE_NUMBER)
        csvfiles.write_csv(lines, args.out, schemas.RATED_HEADER)
    else:
        clients = synth.made_up_clients(spark.range(args.clients))
        header = {inner: outer for outer, inner in schemas.CLIENTS_HEADER.items()}
        csvfiles.write_csv(synth.client_map(clients), f"{args.out}/client_mappings", header)
        lines = synth.synthetic_billing(spark.range(args.rows), clients, date.today())
        header = {inner: outer for outer, inner in schemas.BILLING_HEADER.items()}
        csvfiles.write_csv(lines, f"{args.out}/raw_billing", header)
