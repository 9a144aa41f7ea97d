"""python -m lociflow build|score|simulate|classify|phenotypes [--config FILE] [--setting VALUE ...]

Every setting of a workflow is a flag. What the command line gives counts over the file, and the file over the
defaults.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import MISSING, fields

from pyspark.sql import SparkSession

from lociflow.plans import builder, classifier, phenotypes, simulator
from lociflow.sources import config, tables
from lociflow.sources.sinks import get_logger

SETTINGS = {
    "build": config.BuilderConfig,
    "score": config.ScorerConfig,
    "simulate": config.SimulatorConfig,
    "classify": classifier.ClassifierConfig,
    "phenotypes": config.PhenotypeConfig,
}
#: Arguments of the command line alone.
OWN = ("command", "config", "log_file")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(
        prog="lociflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    commands = top.add_subparsers(dest="command", required=True)
    for name, cls in SETTINGS.items():
        p = commands.add_parser(name)
        p.add_argument("--config", help="YAML file of the settings")
        p.add_argument("--log-file")
        for f in fields(cls):
            default = None if f.default is MISSING else f.default
            flag = f"--{f.name.replace('_', '-')}"
            if isinstance(default, bool):
                p.add_argument(flag, action=argparse.BooleanOptionalAction, default=default)
            elif f.name in config.LISTS:
                p.add_argument(flag, nargs="+", default=default)
            elif f.name in config.MAPPINGS:
                p.add_argument(flag, nargs="+", default=default, metavar="KEY=VALUE", type=_pair)
            else:
                p.add_argument(
                    flag, default=default,
                    type=type(default) if isinstance(default, (int, float)) else str if default or f.default is MISSING else config.scalar
                )
        if not any(f.name == "log_level" for f in fields(cls)):
            p.add_argument("--log-level", default="INFO")
    return top


def _pair(text: str) -> tuple[str, object]:
    key, _, value = text.partition("=")
    return key, config.scalar(value)


def settings(argv: Sequence[str] | None = None) -> tuple[argparse.Namespace, object]:
    """The arguments, and the settings of the command that they, the file and the defaults make together."""
    top = parser()
    args = top.parse_args(argv)
    cls = SETTINGS[args.command]
    own = next(a for a in top._actions if isinstance(a, argparse._SubParsersAction)).choices[args.command]
    merged = config.merge(config.load_yaml(args.config) if args.config else {}, args, own)
    names = {f.name for f in fields(cls)}
    values = {
        k: dict(v) if k in config.MAPPINGS and isinstance(v, list) else v for k, v in vars(merged).items() if k in names
    }
    for f in fields(cls):
        if f.default is MISSING:
            config.require(values, f.name)
    return merged, config.of(cls, values)


def main(argv: Sequence[str] | None = None) -> None:
    args, c = settings(argv)
    get_logger(args.log_file, args.log_level)
    spark = SparkSession.builder.appName(f"lociflow-{args.command}").getOrCreate()
    if args.command == "build":
        print(builder.run(spark, c))
    elif args.command == "score":
        builder.score_all_variants(spark, c.vcf_path, c.fasta_path, c.outdir, c.k, c.embedder, c.embedder_options)
    elif args.command == "simulate":
        simulator.run(spark, c)
    elif args.command == "classify":
        print(classifier.run(spark, c)["metrics"])
    else:
        print(
            phenotypes.run(tables.sheet(spark, c.sheet_file, c.sheet), c.outdir, c.traits or phenotypes.TRAITS, c.stamp)
        )


if __name__ == "__main__":
    main()
