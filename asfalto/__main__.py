"""Run pipeline steps: python -m asfalto --raw <csv folder> --root <table folder> [steps].

Steps: silver, dims, facts, optimize; without any, the first three. `optimize` writes
clustered copies of the facts below <root>-optimized.
"""

from __future__ import annotations

import argparse
import logging
import sys

from asfalto.operators.quality import FAIL
from asfalto.plans import medallion as M
from asfalto.session import session
from asfalto.sources.csv_files import read_folder

# Exit status when a write was incomplete or the quality gate failed.
BROKEN = 1

STEPS = ["silver", "dims", "facts", "optimize"]


def sound(done: dict[str, M.Written]) -> bool:
    """Log what was written; whether all of it can be read and the quality gate held."""
    for table, written in done.items():
        logging.log(
            logging.INFO if written.complete else logging.ERROR,
            "%s: %d rows written, %d read back", table, written.written, written.read_back,
        )
    return all(w.complete and w.metrics.get("veredito") != FAIL for w in done.values())


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="asfalto", description=__doc__.splitlines()[0])
    parser.add_argument("steps", nargs="*", help=f"any of {', '.join(STEPS)}")
    parser.add_argument("--raw", help="folder of raw CSV files, for the silver step")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    args = parser.parse_args(arguments)
    steps = args.steps or STEPS[:3]
    if unknown := set(steps) - set(STEPS):
        parser.error(f"unknown step: {', '.join(sorted(unknown))}")
    if "silver" in steps and not args.raw:
        parser.error("the silver step needs --raw")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = session()
    lake = M.Lake(spark, args.root)
    work = {
        "silver": lambda: {M.SILVER: M.build_silver(lake, read_folder(spark, args.raw), args.mode)},
        "dims": lambda: M.build_dims(lake),
        "facts": lambda: M.build_facts(lake),
        "optimize": lambda: {
            f"{t} (optimized)": w for t, w in M.optimize(lake, f"{lake.root}-optimized").items()
        },
    }
    for step in STEPS:
        if step in steps:
            done = work[step]()
            if step == "silver":
                logging.info("quality: %s", done[M.SILVER].metrics)
            if not sound(done):
                logging.error("%s failed; no later step is run", step)
                return BROKEN
    return 0


if __name__ == "__main__":
    sys.exit(main())
