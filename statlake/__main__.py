"""Run the jobs: ``python -m statlake --root /shared/lake [--layer all|bronze|silver|gold]``.

Under spark-submit the submitted master stays; ``--local N`` runs on N local threads.
"""

from __future__ import annotations

import argparse

from statlake.layout import Layout
from statlake.plans.bronze import run_bronze
from statlake.plans.gold import run_gold
from statlake.plans.silver import run_silver
from statlake.session import job_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="statlake")
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--root", help="lake root holding raw/ (and receiving bronze/ silver/ gold/)")
    where.add_argument("--config", help="YAML file with the layout (root, edstats_file)")
    parser.add_argument("--layer", default="all", choices=["all", "bronze", "silver", "gold"])
    parser.add_argument("--local", metavar="N", help="run on N local threads, whatever was submitted")
    args = parser.parse_args(argv)

    spark = job_session(local=args.local)
    layout = Layout.from_yaml(args.config) if args.config else Layout(args.root)
    steps = {"bronze": [run_bronze], "silver": [run_silver], "gold": [run_gold]}
    for step in steps.get(args.layer, [run_bronze, run_silver, run_gold]):
        step(spark, layout)


if __name__ == "__main__":
    main()
