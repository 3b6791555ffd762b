"""``spark-submit`` entry: rank the pages of a dump.

    spark-submit --py-files linktide.zip linktide/__main__.py INPUT OUTPUT
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from linktide.operators.rank import DAMPING, ROUNDS
from linktide.plans.rank_dump import rank_dump


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="linktide", description=rank_dump.__doc__)
    parser.add_argument("input", nargs="+", help="dump files, folders or globs")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("--iterations", type=int, default=ROUNDS)
    parser.add_argument("--damping", type=float, default=DAMPING)
    parser.add_argument("--snapshots", type=int, nargs="+")
    parser.add_argument("--format", choices=("text", "parquet"), default="text")
    parser.add_argument("--replace", action="store_true", help="remove results that are there")
    parser.add_argument("--versioned", action="store_true", help="publish by a pointer once whole")
    parser.add_argument("--resume", action="store_true", help="go on after the last whole round")
    parser.add_argument("--quarantine", action="store_true", help="write what could not be read")
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.WARNING)
    logging.getLogger("linktide").setLevel(logging.INFO)
    report = rank_dump(
        SparkSession.builder.appName("linktide").getOrCreate(),
        options.input,
        options.output,
        iterations=options.iterations,
        damping=options.damping,
        snapshots=options.snapshots,
        output_format=options.format,
        replace=options.replace,
        versioned=options.versioned,
        resume=options.resume,
        quarantine=options.quarantine,
    )
    print(f"pages: {report.n_pages}, links: {report.n_links}")
    print(f"blocks: {report.n_blocks}, corrupt: {report.n_corrupt}, untitled: {report.n_untitled}")
    for number, total, sink in report.masses:
        print(f"round {number}: total mass {total}, held by pages without outlinks {sink}")


if __name__ == "__main__":
    main()
