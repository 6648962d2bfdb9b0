"""View options and the task profiles they come from."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.functions.vocabularies import BENCH_TASK_PROFILES

AUTO = "task-auto"
INTERPOLATIONS = ("none", "nearest", "linear")
LAYOUTS = ("canonical", "flat", "link-subcarrier")


@dataclass(frozen=True)
class ViewOptions:
    """What a view asks for; anything left out keeps the recording's own value."""

    target_rate_hz: float | None = None
    duration_s: float | None = None
    target_length: int | None = None
    interpolation: str = "linear"
    layout: str = "canonical"
    links: int | None = None
    subcarriers: int | None = None
    tx_links: int | None = None
    rx_links: int | None = None
    profile: str | None = None

    def __post_init__(self):
        for name in ("target_rate_hz", "duration_s", "target_length", "links", "subcarriers",
                     "tx_links", "rx_links"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")
        if self.interpolation not in INTERPOLATIONS:
            raise ValueError(f"interpolation must be one of {', '.join(INTERPOLATIONS)}")
        if self.layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {', '.join(LAYOUTS)}")

    @property
    def requested(self) -> bool:
        return self != ViewOptions()

    @property
    def has_time(self) -> bool:
        return any(v is not None for v in (self.target_rate_hz, self.duration_s, self.target_length))

    @property
    def length_limit(self) -> int | None:
        """The longest window the options allow, if they say so."""
        if self.target_length is not None:
            return int(self.target_length)
        if self.duration_s is not None and self.target_rate_hz is not None:
            return max(1, round(self.duration_s * self.target_rate_hz))
        return None


# Rate, duration and length of the task profiles, and the older names for them.
PROFILES = {
    AUTO: ViewOptions(profile=AUTO),
    "general-sensing": ViewOptions(target_rate_hz=100.0, duration_s=3.0, profile="general-sensing"),
    "vital-sign": ViewOptions(target_rate_hz=10.0, duration_s=30.0, profile="vital-sign"),
    "semantic-bvp": ViewOptions(target_length=22, interpolation="none", profile="semantic-bvp"),
}
OLDER_NAMES = {
    "clip-4s-100hz": "general-sensing", "clip-3s-100hz": "general-sensing",
    "clip-3s-native": "general-sensing", "clip-1.8s-100hz": "general-sensing",
    "continuous-100hz": "general-sensing", "continuous-native": "general-sensing",
    "native-10hz": "vital-sign", "vital-native-plus-20hz": "vital-sign",
    "clip-250-packets": "general-sensing", "clip-500-packets": "general-sensing",
    "clip-native": "general-sensing",
}
DEFAULT_PROFILE = "general-sensing"


def resolve_profile(name: str | None = None, options: ViewOptions | None = None) -> ViewOptions:
    """Options of a profile (or an older name for it).

    ``options`` that already fix time win over the profile; options that only shape channels
    take the profile's time.
    """
    key = OLDER_NAMES.get(name, name) if name else DEFAULT_PROFILE
    if key not in PROFILES:
        raise ValueError(f"unknown task profile {name!r}; choose one of: {', '.join(sorted(PROFILES))}")
    base = PROFILES[key]
    if options is None or not options.requested:
        return base
    if options.has_time:
        return options
    return replace(options, target_rate_hz=base.target_rate_hz, duration_s=base.duration_s,
                   target_length=base.target_length, profile=base.profile)


def profile_table(spark: SparkSession) -> DataFrame:
    """Every profile name, old or new, with its options: a few rows for broadcast joins."""
    rows = [(name, p.profile, p.target_rate_hz, p.duration_s, p.target_length, p.interpolation)
            for name, p in [*PROFILES.items(), *((o, PROFILES[n]) for o, n in OLDER_NAMES.items())]]
    return spark.createDataFrame(
        rows, "name string, profile string, target_rate_hz double, duration_s double, "
              "target_length long, interpolation string")


def resolve_profiles(df: DataFrame, name: str) -> DataFrame:
    """Profile options per row; an empty name means the default, an unknown one an error text."""
    table = profile_table(df.sparkSession).withColumnRenamed("name", "_name")
    wanted = F.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(DEFAULT_PROFILE)).otherwise(
        F.col(name))
    rows = df.join(F.broadcast(table), wanted == F.col("_name"), "left").drop("_name")
    return rows.withColumn("error", F.when(F.col("profile").isNull(), F.concat(
        F.lit("unknown task profile "), F.col(name), F.lit("; choose one of: "),
        F.lit(", ".join(sorted(PROFILES))))))


def bench_task(label, path):
    """The task a recording is labelled with, else the first task name in its path."""
    found = F.lit("Multitask")
    for task in reversed(BENCH_TASK_PROFILES):
        found = F.when(F.contains(T.unix_path(path), F.lit(task)), F.lit(task)).otherwise(found)
    return F.when(label.isin(*BENCH_TASK_PROFILES), label).otherwise(found)


def task_view(df: DataFrame, label: str, path: str, options: ViewOptions | None = None) -> DataFrame:
    """Task, profile, rate and duration per recording; requested values win over the task's."""
    asked = options or ViewOptions()
    pairs = [F.lit(x) for kv in BENCH_TASK_PROFILES.items() for x in kv]
    rows = df.withColumn("task", bench_task(F.col(label), F.col(path)))
    rows = rows.withColumn("profile", F.element_at(F.create_map(*pairs), F.col("task")))
    vital = F.col("profile") == "vital-sign"

    def pick(field: str):
        own = getattr(asked, field)
        if own is not None:
            return F.lit(float(own))
        return F.when(vital, F.lit(getattr(PROFILES["vital-sign"], field))).otherwise(
            F.lit(getattr(PROFILES["general-sensing"], field)))

    rate, duration = pick("target_rate_hz"), pick("duration_s")
    limit = F.lit(asked.target_length).cast("long") if asked.target_length is not None else \
        F.greatest(F.lit(1), F.rint(rate * duration)).cast("long")
    return (rows.withColumn("target_rate_hz", rate).withColumn("duration_s", duration)
            .withColumn("profile_max_length", limit))
