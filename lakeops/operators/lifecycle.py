"""Object lifecycle rules by age."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Storage classes from the dearest to the cheapest at rest.
STORAGE_CLASSES = ["STANDARD", "NEARLINE", "COLDLINE", "ARCHIVE"]


@dataclass(frozen=True)
class LifecycleRule:
    age_days: int
    action: str
    storage_class: str | None = None

    def __post_init__(self):
        if self.action not in ("DELETE", "SET_STORAGE_CLASS"):
            raise ValueError(f"unknown action {self.action}")
        if self.action == "SET_STORAGE_CLASS" and self.storage_class not in STORAGE_CLASSES:
            raise ValueError(f"storage class is one of {STORAGE_CLASSES}")


def lifecycle(objects: DataFrame, rules: list[LifecycleRule], now: Column) -> DataFrame:
    """The action due per object. DELETE beats a class change; of those the cheapest wins."""
    age = F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("created").cast("timestamp")))
                  / F.lit(86_400_000_000)).cast("bigint")
    due = F.lit(None).cast("string")
    target = F.lit(None).cast("string")
    changes = sorted((r for r in rules if r.action != "DELETE"),
                     key=lambda r: STORAGE_CLASSES.index(r.storage_class))
    for rule in changes:
        met = age >= rule.age_days
        due = F.when(met, rule.action).otherwise(due)
        target = F.when(met, rule.storage_class).otherwise(target)
    for rule in rules:
        if rule.action == "DELETE":
            due = F.when(age >= rule.age_days, rule.action).otherwise(due)
            target = F.when(age >= rule.age_days, F.lit(None)).otherwise(target)
    return objects.withColumn("age_days", age).withColumn("due", due).withColumn("target_class", target)
