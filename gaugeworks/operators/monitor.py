"""Queries over platform logs: consumer lag, utilisation, failed runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.stats import maximum, mean
from gaugeworks.operators.windows import tumbling

# --- Fixed values: names in the logs and alert thresholds ---
BROKER_PROVIDER = "MICROSOFT.EVENTHUB"
LAG_ACTIVITY = "ConsumerLag"
CONSUMER_GROUPS = ("stream-analytics-local-emulation", "$Default")
LAG_ABOVE = 1000
STREAM_PROVIDER = "MICROSOFT.STREAMANALYTICS"
UTILISATION_METRIC = "ResourceUtilization"
BACKLOG_METRIC = "BacklogedInputEvents"
UTILISATION_ABOVE = 80
BACKLOG_ABOVE = 0
BIN = "5 minutes"
PIPELINE = "pl_daily_batch_trigger"
STAGES = ("bronze_ingest", "silver_clean_dedup", "gold_aggregate_zorder")
RUN_FAILED = "Failed"
ACTIVITY_FAILED = ("Failed", "TimedOut")


def _is_lag() -> Column:
    return (F.col("ResourceProvider") == BROKER_PROVIDER) & (F.col("ActivityName_s") == LAG_ACTIVITY)


def consumer_lag(log: DataFrame, groups: tuple[str, ...] = CONSUMER_GROUPS) -> DataFrame:
    """Lag records of the watched consumer groups."""
    return log.filter(_is_lag() & F.col("ChildEntityName_s").isin(*groups)).select(
        "TimeGenerated",
        F.col("ChildEntityName_s").alias("ConsumerGroup"),
        F.col("EntityName_s").alias("EventHubName"),
        F.col("PartitionId_s").alias("PartitionId"),
        F.col("Count_d").alias("LagCount"),
    )


def lag_listing(log: DataFrame) -> DataFrame:
    return consumer_lag(log).orderBy(F.desc_nulls_last("TimeGenerated"), F.asc_nulls_last("PartitionId"))


def lag_alert(log: DataFrame, above: float = LAG_ABOVE) -> DataFrame:
    worst = consumer_lag(log).groupBy("EventHubName", "PartitionId").agg(F.max("LagCount").alias("MaxLag"))
    return worst.filter(F.col("MaxLag") > above)


def _metric(log: DataFrame, name: str) -> DataFrame:
    return log.filter((F.col("ResourceProvider") == STREAM_PROVIDER) & (F.col("MetricName") == name))


def _bins(metric: DataFrame, stats, keys=()) -> DataFrame:
    """Aggregates per bin, labelled with the start of the bin."""
    ends = tumbling(metric, "TimeGenerated", BIN, list(keys), stats, end="_end")
    return ends.withColumn("TimeGenerated", F.col("_end") - F.expr(f"INTERVAL {BIN}")).drop("_end")


def utilisation(log: DataFrame) -> DataFrame:
    stats = [mean("Average", "AvgUtilization"), maximum("Maximum", "MaxUtilization")]
    return _bins(_metric(log, UTILISATION_METRIC), stats).orderBy(F.desc_nulls_last("TimeGenerated"))


def utilisation_alert(log: DataFrame, above: float = UTILISATION_ABOVE) -> DataFrame:
    return utilisation(log).filter(F.col("AvgUtilization") > above)


def backlog(log: DataFrame, above: float = BACKLOG_ABOVE) -> DataFrame:
    """Bins with any backlog at all."""
    return _bins(_metric(log, BACKLOG_METRIC), [maximum("Maximum", "MaxBacklog")]).filter(F.col("MaxBacklog") > above)


def load_signals(log: DataFrame) -> DataFrame:
    """Utilisation and backlog as one series with a metric name: a job can fall behind while its
    utilisation looks low, so neither alone will do. One scan of the log and one shuffle give both."""
    both = log.filter(
        (F.col("ResourceProvider") == STREAM_PROVIDER) & F.col("MetricName").isin(UTILISATION_METRIC, BACKLOG_METRIC)
    ).withColumnRenamed("MetricName", "metric")
    bins = _bins(both, [mean("Average", "_mean"), maximum("Maximum", "_max")], ["metric"])
    used = F.col("metric") == UTILISATION_METRIC
    return bins.filter(used | (F.col("_max") > BACKLOG_ABOVE)).select(
        "TimeGenerated",
        F.when(used, F.col("_mean")).alias("AvgUtilization"),
        F.when(used, F.col("_max")).alias("MaxUtilization"),
        F.when(~used, F.col("_max")).alias("MaxBacklog"),
        "metric",
    )


def _failed_activities(activities: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    return activities.filter(F.col("Status").isin(*ACTIVITY_FAILED) & F.col("ActivityName").isin(*stages))


def failed_runs(
    runs: DataFrame, activities: DataFrame, pipeline: str = PIPELINE, stages: tuple[str, ...] = STAGES
) -> DataFrame:
    """Failed runs with the error of each failed activity. Both sides are filtered and narrowed
    ahead of the join; a run without a failed activity of the named stages is not listed."""
    failed = runs.filter((F.col("PipelineName") == pipeline) & (F.col("Status") == RUN_FAILED)).select(
        "RunId",
        F.col("TimeGenerated").alias("PipelineTimeGenerated"),
        F.col("Start").alias("PipelineStart"),
        F.col("End").alias("PipelineEnd"),
        "Parameters",
    )
    errors = _failed_activities(activities, stages).select(
        "PipelineRunId", F.col("ActivityName").alias("FailedActivityName"), "ErrorCode", "ErrorMessage"
    )
    return (
        failed.join(errors, F.col("RunId") == F.col("PipelineRunId"))
        .select(
            "PipelineTimeGenerated",
            "RunId",
            "FailedActivityName",
            "ErrorCode",
            "ErrorMessage",
            "PipelineStart",
            "PipelineEnd",
            "Parameters",
        )
        .orderBy(F.desc_nulls_last("PipelineTimeGenerated"))
    )


def failures_by_stage(activities: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    return (
        _failed_activities(activities, stages)
        .groupBy("ActivityName")
        .agg(F.count("*").alias("FailureCount"))
        .orderBy(F.desc("FailureCount"), "ActivityName")
    )


def presence(log: DataFrame, wanted: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows in the log beside rows that match: none matching out of many means healthy, out of none
    means that nothing is being logged."""
    return log.groupBy(*by).agg(F.count("*").alias("log_rows"), F.count_if(wanted).alias("matching_rows"))


def lag_presence(log: DataFrame) -> DataFrame:
    return presence(log, _is_lag())
