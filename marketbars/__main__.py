"""``spark-submit`` entry: ``python -m marketbars STEP [--config FILE] [--base-path DIR]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marketbars.config import load_config
from marketbars.plans.jobs import STEPS, run_all, update_features


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run a market-bar job.")
    steps = {**STEPS, "all": run_all, "update": update_features}
    parser.add_argument("step", choices=list(steps))
    parser.add_argument("--config", help="JSON or YAML settings file")
    parser.add_argument("--base-path", help="folder under which relative paths lie")
    args = parser.parse_args(argv)

    config = load_config(args.config, args.base_path)
    spark = SparkSession.builder.appName(config.project.name).getOrCreate()
    print(steps[args.step](spark, config))


if __name__ == "__main__":
    main()
