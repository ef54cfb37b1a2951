"""Command line: ``python -m municare ingest-file|ingest-json|build|check ...``."""

from __future__ import annotations

import argparse
import json

from municare.intake import FILE_GROUPS, JSON_LAYOUTS, ingest_file, ingest_json, open_raw
from municare.plans import MODELS, build_marts, check_marts, open_marts
from municare.schemas import RAW_SCHEMAS
from municare.session import build_session, size_shuffles
from municare.sources.lookups import REFERENCE_CODES


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="municare")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=text)
        added.add_argument("--root", required=True, help="folder of the stored tables")
        return added

    files = command("ingest-file", "load one landed register file")
    files.add_argument("--landing", required=True)
    files.add_argument("--table", required=True, choices=sorted(FILE_GROUPS))
    files.add_argument("--uf", default="RJ")
    files.add_argument("--year", type=int, required=True)
    files.add_argument("--month", type=int)
    files.add_argument("--extension", default="parquet")
    files.add_argument("--scope", nargs="+", default=REFERENCE_CODES, help="six-digit municipality codes")

    answers = command("ingest-json", "load saved API answers")
    answers.add_argument("--path", required=True)
    tables = sorted([*JSON_LAYOUTS, "raw_ibge.populacao_estimada"])
    answers.add_argument("--table", required=True, choices=tables)
    answers.add_argument("--url", required=True)
    answers.add_argument("--year", type=int)
    answers.add_argument("--partitions", type=json.loads, help="JSON list of what was asked for")

    build = command("build", "build views and marts")
    build.add_argument("--bootstrap-period")
    build.add_argument("--models", nargs="+", choices=sorted(MODELS))

    check = command("check", "run the declared checks on the stored marts")
    for reader in (build, check):
        reader.add_argument("--may-be-empty", nargs="+", default=[], choices=sorted(RAW_SCHEMAS), help="raw tables that were never loaded")
    return top


def main(arguments: list[str] | None = None) -> None:
    asked = vars(parser().parse_args(arguments))
    run, root = asked.pop("command"), asked.pop("root")
    spark = build_session()
    size_shuffles(spark, asked.get("landing") or asked.get("path") or root)
    if run == "ingest-file":
        ingest_file(spark, asked.pop("landing"), root, **asked)
    elif run == "ingest-json":
        ingest_json(spark, asked.pop("path"), root, **asked)
    elif run == "build":
        raw = open_raw(spark, root, asked["may_be_empty"])
        build_marts(spark, raw, root, asked["bootstrap_period"], asked["models"])
    else:
        check_marts(open_marts(spark, open_raw(spark, root, asked["may_be_empty"]), root), root)


if __name__ == "__main__":
    main()
