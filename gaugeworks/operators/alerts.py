"""Rolling averages and anomaly alerts per sensor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.stats import Stat, count, maximum, mean, minimum
from gaugeworks.functions.times import epoch_seconds
from gaugeworks.operators.keep import first_per_key
from gaugeworks.operators.windows import hopping, sliding

# --- Fixed values: window lengths and thresholds ---
ROLLING_SIZE, ROLLING_SLIDE = "10 minutes", "2 minutes"
ALERT_WINDOW = "15 minutes"
SWING_ABOVE, AQI_FROM = 8.0, 5


def rolling_stats() -> list[Stat]:
    return [
        mean("temp", "avg_temp"),
        minimum("temp", "min_temp"),
        maximum("temp", "max_temp"),
        mean("humidity", "avg_humidity"),
        mean("aqi", "avg_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        count("observation_count"),
    ]


def rolling_averages(
    events: DataFrame, time: str = "poll_timestamp", closed: str = "left"
) -> DataFrame:
    """Ten-minute averages per city, every two minutes."""
    return hopping(events, time, ROLLING_SIZE, ROLLING_SLIDE, ["city_id"], rolling_stats(), closed=closed)


ALERT_STATS = [
    maximum("temp", "window_max_temp"),
    minimum("temp", "window_min_temp"),
    maximum("aqi", "window_max_aqi"),
    maximum("pm2_5", "window_max_pm2_5"),
]


def alert_id(city: str | Column, at: str | Column) -> Column:
    """The same window always gets the same id, so writing it again replaces it."""
    city = F.col(city) if isinstance(city, str) else city
    return F.concat(city, F.lit("-"), epoch_seconds(at).cast("string"))


@dataclass(frozen=True)
class AnomalyRule:
    """Fires when temperatures spread by more than ``swing`` or the air index reaches ``aqi``."""

    swing: float = SWING_ABOVE
    aqi: int = AQI_FROM

    def apply(self, windows: DataFrame, at: str = "detected_at") -> DataFrame:
        """Windows on which the rule fires, as alert documents. An unknown side never blocks the
        other: unknown OR true is true; the flag of an unknown side is false."""
        swing = F.col("window_max_temp") - F.col("window_min_temp")
        by_swing, by_aqi = swing > self.swing, F.col("window_max_aqi") >= self.aqi
        return windows.filter(by_swing | by_aqi).select(
            alert_id("city_id", at).alias("id"),
            "city_id",
            "window_max_temp",
            "window_min_temp",
            swing.alias("temp_swing"),
            "window_max_aqi",
            "window_max_pm2_5",
            F.coalesce(by_swing, F.lit(False)).alias("temperature_swing_triggered"),
            F.coalesce(by_aqi, F.lit(False)).alias("aqi_threshold_triggered"),
            F.col(at).alias("detected_at"),
        )


def anomaly_alerts(
    events: DataFrame, time: str = "poll_timestamp", rule: AnomalyRule = AnomalyRule(), splits: int = 15
) -> DataFrame:
    """Alerts over the last fifteen minutes, evaluated whenever a reading enters or leaves."""
    windows = sliding(events, time, ALERT_WINDOW, ["city_id"], ALERT_STATS, end="detected_at", splits=splits)
    return rule.apply(windows)


def newest_alerts(alerts: DataFrame) -> DataFrame:
    """One document per id. Ids have a resolution of a second; the later window wins."""
    return first_per_key(alerts, ["id"], [F.col("detected_at").desc()])
