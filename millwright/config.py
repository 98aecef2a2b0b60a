"""Settings shared by all layers, and the session defaults the package is tested with."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import SparkSession

from millwright.scratch import shared_folder

RUN = "RUN"
CHANGEOVER = "CHANGEOVER"
MAINTENANCE = "PLANNED_DOWNTIME_PM"
NO_ORDER = "NO_ORDER"
UNKNOWN = "UNKNOWN"
MINOR = "MINOR"
MAJOR = "MAJOR"

STATUS_GROUPS = (RUN, CHANGEOVER, MAINTENANCE, NO_ORDER, UNKNOWN)
STOPPAGE_CLASSES = (MINOR, MAJOR)


@dataclass(frozen=True)
class Settings:
    """Thresholds and labels. The defaults are fixed values the results depend on."""

    # category prefix (case-insensitive) -> status group, first match wins
    status_prefixes: tuple[tuple[str, str], ...] = (
        ("run time", RUN),
        ("cc", CHANGEOVER),
        ("pm", MAINTENANCE),
        ("no", NO_ORDER),
    )
    junk_categories: tuple[str, ...] = ("0", "")
    outlier_minutes: int = 1440
    major_minutes: int = 3
    world_class_pct: Decimal = Decimal("85.0")
    pm_reduction: Decimal = Decimal("0.15")
    reason_count: int = 3
    reason_separator: str = " · "
    weekend_label: str = "Cuối tuần"
    weekday_label: str = "Ngày thường"
    gap_rows: int = 20
    freshness_warn_days: int = 3650
    freshness_error_days: int = 7300


DEFAULTS = Settings()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; see ``millwright.scratch``."""
    return shared_folder(spark)


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Runtime settings that size shuffles for an input; apply with ``spark.conf.set``.

    Adaptive execution joins small partitions and splits skewed ones, so the start may be
    generous: one partition per 200 MB at any size. Where the blocks of one shuffle become
    too many, build the input in months (``plans.build.refresh_months``).
    """
    partitions = max(input_bytes // (200 * 2**20), 200)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.files.maxPartitionBytes": "256MB",
    }


def local_session(cpus: str = "8", **extra: str) -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millwright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # no Python call site per column, which costs a good part of composing a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
