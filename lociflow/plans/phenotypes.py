"""Phenotype sheets to one table for each trait."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from lociflow.operators.phenotype import process_trait
from lociflow.sources import sinks

#: The traits of the sheet.
TRAITS = ("SPY", "ETN", "TGP", "TGW")


def run(sheet: DataFrame, outdir: str, traits: Sequence[str] = TRAITS, stamp: str | None = None) -> dict[str, str]:
    """Writes sample, value, loc_* of every trait; the day of the run, or the stamp given, ends the names."""
    stamp = date.today().strftime("%Y%m%d") if stamp is None else stamp
    return {t: sinks.save_csv(process_trait(sheet, t), f"{outdir}/{t}_{stamp}.csv") for t in traits}
