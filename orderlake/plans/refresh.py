"""The bounded reporting refresh: load, build, test, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.config import LakeConfig
from orderlake.operators.mart import hourly_mart, stage_metrics, stage_status
from orderlake.operators.quality import (
    enforce,
    metrics_constraints,
    require_passing,
    run_suite,
    status_constraints,
)
from orderlake.operators.upsert import upsert_metrics, upsert_status
from orderlake.schemas import (
    GOLD_METRICS,
    GOLD_STATUS,
    METRICS_KEY,
    METRICS_TABLE,
    STATUS_KEY,
    STATUS_TABLE,
)
from orderlake.sources.published import (
    commit_generation,
    current_generation,
    read_published,
    stage_tables,
)
from orderlake.sources.readers import scan_final

METRICS = "order_metrics_hourly"
STATUS = "order_status_hourly"
MART = "fct_hourly_commerce_metrics"


def _tables(config: LakeConfig) -> str:
    return f"{config.reporting}/tables"


def _marts(config: LakeConfig) -> str:
    return f"{config.reporting}/marts"


def _gold(
    spark: SparkSession, path: str, schema: StructType, keys: list[str], since: str | None
) -> DataFrame:
    gold = scan_final(spark, path, schema, keys)
    if gold.isEmpty():
        raise FileNotFoundError(f"no gold rows in {path}")
    if since is not None:
        gold = gold.filter(F.col("window_date") >= F.lit(since).cast("date"))
    return gold.drop("window_date")


def load_reporting_tables(
    spark: SparkSession, config: LakeConfig, since: str | None = None
) -> dict[str, DataFrame]:
    """Merge gold into both reporting tables, and show both or neither.

    ``since`` limits the gold input to windows from that date on.
    """
    root, keep = _tables(config), config.keep_generations
    last = current_generation(spark, root)
    metrics = read_published(spark, root, METRICS, METRICS_TABLE, keep, last)
    status = read_published(spark, root, STATUS, STATUS_TABLE, keep, last)
    merged = {
        METRICS: upsert_metrics(
            metrics, _gold(spark, config.gold_metrics, GOLD_METRICS, METRICS_KEY, since)
        ),
        STATUS: upsert_status(
            status, _gold(spark, config.gold_status, GOLD_STATUS, STATUS_KEY, since)
        ),
    }
    staged = stage_tables(spark, root, last + 1, merged, keep)
    enforce(
        {
            METRICS: (staged[METRICS], metrics_constraints(), METRICS_KEY),
            STATUS: (staged[STATUS], status_constraints(), STATUS_KEY),
        }
    )
    commit_generation(spark, root, last + 1)
    return staged


def reporting_frames(metrics: DataFrame, status: DataFrame) -> dict[str, DataFrame]:
    """Tables, staging views and mart under the names the test suite uses."""
    staged_metrics, staged_status = stage_metrics(metrics), stage_status(status)
    return {
        METRICS: metrics,
        STATUS: status,
        "stg_order_metrics_hourly": staged_metrics,
        "stg_order_status_hourly": staged_status,
        MART: hourly_mart(staged_metrics, staged_status),
    }


def refresh_marts(
    spark: SparkSession, config: LakeConfig, since: str | None = None
) -> DataFrame:
    """Load the reporting tables, rebuild the mart, test, publish the mart.

    Stops at the first failure, and then keeps the mart that was published
    before. Running it again changes nothing but the load times.
    """
    tables = load_reporting_tables(spark, config, since)
    frames = reporting_frames(tables[METRICS], tables[STATUS])
    root = _marts(config)
    generation = current_generation(spark, root) + 1
    staged = stage_tables(
        spark, root, generation, {MART: frames[MART]}, config.keep_generations
    )
    require_passing(run_suite({**frames, MART: staged[MART]}))
    commit_generation(spark, root, generation)
    return staged[MART]


def read_mart(spark: SparkSession, config: LakeConfig, schema) -> DataFrame:
    """The mart as last published."""
    return read_published(spark, _marts(config), MART, schema, config.keep_generations)
