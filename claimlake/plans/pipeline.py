"""The three layers in order, in one Spark application. The first failure stops the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from claimlake.config import PipelineConfig
from claimlake.plans.bronze import run_bronze
from claimlake.plans.gold import run_gold
from claimlake.plans.silver import run_silver
from claimlake.sources.store import TableStore


@dataclass(frozen=True)
class RunIds:
    bronze: str
    silver: str
    gold: str


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> RunIds:
    store = TableStore(spark, config)
    store.create_namespaces()
    return RunIds(bronze=run_bronze(store), silver=run_silver(store), gold=run_gold(store))
