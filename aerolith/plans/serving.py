"""Serving queries over the four views. Every query is a DataFrame; none loops over stations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import rules
from aerolith.operators import filters, joins, latest, projections, ranking, rollups

SERIES_COLUMNS = ("timestamp", "temperature", "humidity", "pm25", "no2", "aqi_index")
DAILY_COLUMNS = ("date", "avg_temp", "max_temp", "min_temp", "avg_pm25", "avg_aqi", "peak_aqi_hour")
RANK_COLUMNS = ("station_id", "province", "region", "avg_temp", "avg_pm25")


def _required(station_id: str | None) -> str:
    if not station_id:
        raise ValueError("station_id is required")
    return station_id


def explode_alerts(latest_rows: DataFrame) -> DataFrame:
    """No, one or two alert rows per station row."""

    def alert(wanted, kind: str, level: str, value: str):
        fields = F.struct(
            F.lit(kind).alias("alert_type"),
            F.col(level).alias("level"),
            F.col(value).cast("double").alias("value"),
        )
        return F.when(F.col(level).isin(*wanted), fields)

    both = F.array(
        alert(rules.ALERT_AQI, "Air Quality", "aqi_alert", "aqi_index"),
        alert(rules.ALERT_TEMP, "Temperature", "temp_alert", "temperature"),
    )
    return latest_rows.select(
        "station_id", "province", "region", F.inline(F.array_compact(both)), "timestamp"
    )


def compare_columns(joined: DataFrame) -> DataFrame:
    """Current against baseline, with both deviations."""
    return joined.select(
        "station_id",
        "province",
        "region",
        F.col("temperature").alias("current_temp"),
        "historical_avg_temp",
        F.col("pm25").alias("current_pm25"),
        "historical_avg_pm25",
        F.col("aqi_index").alias("current_aqi"),
        rules.deviation("temperature", "historical_avg_temp", 1).alias("temp_deviation"),
        rules.deviation("pm25", "historical_avg_pm25", 2).alias("pm25_deviation"),
    )


@dataclass(frozen=True)
class Serving:
    """Queries over the views. ``tiebreak`` orders readings of one station with equal times.

    ``snapshot`` says that the live view holds one row per station, as the keyed sink keeps it;
    otherwise the latest reading of each station is picked out first. ``filed_by_day`` says that the hourly
    view is partitioned by date, so that timelines open the days they show only.
    Where a station is asked for, ``station_id=None`` through the ``*_all`` form answers for
    every station at once.
    """

    realtime_rows: DataFrame | None = None
    hourly_rows: DataFrame | None = None
    daily_rows: DataFrame | None = None
    summary_rows: DataFrame | None = None
    registry: DataFrame | None = None
    tiebreak: Sequence[str] = ()
    snapshot: bool = False
    filed_by_day: bool = False

    def _latest(self, station_id: str | None = None, province: str | None = None) -> DataFrame:
        matched = filters.match_optional(self.realtime_rows, station_id=station_id, province=province)
        if self.snapshot:
            return matched.drop("_id")
        return latest.latest_rows(matched, ["station_id"], "timestamp", self.tiebreak).drop("_id")

    def realtime(self, station_id: str | None = None, province: str | None = None) -> DataFrame:
        """Latest reading per station."""
        return self._latest(station_id, province).orderBy("station_id")

    def realtime_series(self, station_id: str, limit: int | str | None = None) -> DataFrame:
        """The newest readings of one station, oldest first."""
        rows = self.hourly_rows.where(F.col("station_id") == _required(station_id))
        newest = rows.orderBy(F.desc("timestamp"), *[F.desc(c) for c in self.tiebreak])
        return (
            newest.limit(latest.clamp_limit(limit)).select(*SERIES_COLUMNS).orderBy("timestamp")
        )

    def realtime_series_all(self, limit: int | str | None = None) -> DataFrame:
        rows = latest.last_n(
            self.hourly_rows, latest.clamp_limit(limit), tiebreak=self.tiebreak
        )
        return rows.select("station_id", *SERIES_COLUMNS).orderBy("station_id", "timestamp")

    def hourly(self, station_id: str, date: str | None = None) -> DataFrame:
        """Day timeline of one station; its latest day unless a date is given."""
        rows = self.hourly_rows.where(F.col("station_id") == _required(station_id))
        return self._timeline(rows, date).drop("station_id").orderBy("timestamp")

    def hourly_all(self, date: str | None = None) -> DataFrame:
        return self._timeline(self.hourly_rows, date).orderBy("station_id", "timestamp")

    def _timeline(self, rows: DataFrame, date: str | None) -> DataFrame:
        last = latest.latest_day_of_view if self.filed_by_day else latest.latest_day
        day = filters.match_optional(rows, date=date) if date else last(rows)
        return projections.with_hour(day.select("station_id", *SERIES_COLUMNS))

    def daily(self, station_id: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """Daily rows of one station in a date range, ascending."""
        rows = filters.match_optional(self.daily_rows, station_id=_required(station_id))
        return filters.date_range(rows, start, end).select(*DAILY_COLUMNS).orderBy("date")

    def daily_all(self, start: str | None = None, end: str | None = None) -> DataFrame:
        rows = filters.date_range(self.daily_rows, start, end)
        return rows.select("station_id", *DAILY_COLUMNS).orderBy("station_id", "date")

    def provinces(self) -> DataFrame:
        """Every station's summary."""
        return self.summary_rows.orderBy("region", "province", "station_id")

    def top_stations(self, metric: str, n: int = 5) -> DataFrame:
        return ranking.top_n(self.summary_rows, metric, n).select(*RANK_COLUMNS)

    def national(self, how: str = "fixed") -> DataFrame:
        return rollups.national_means(self.summary_rows, how)

    def stats(self, how: str = "fixed") -> dict[str, DataFrame]:
        """Five hottest, five most polluted, and the national means."""
        return {
            "top_hottest_stations": self.top_stations("avg_temp"),
            "top_polluted_stations": self.top_stations("avg_pm25"),
            "national": self.national(how),
        }

    def stats_table(self, how: str = "fixed", n: int = 5) -> DataFrame:
        """All of ``stats`` as one table, by ``section`` and ``place``, from one pass over the summary.

        Each task forwards at most ``n`` rows of either list and one row of sums for the means.
        """
        lists = ranking.top_lists(self.summary_rows, {"hottest": "avg_temp", "polluted": "avg_pm25"}, n)
        listed = lists.select(F.col("list").alias("section"), "place", *RANK_COLUMNS)
        national = self.national(how).withColumnsRenamed({"national_avg_temp": "avg_temp", "national_avg_pm25": "avg_pm25"})
        return listed.unionByName(national.withColumn("section", F.lit("national")), allowMissingColumns=True)

    def alerts(self, province: str | None = None, severity: str = "all") -> DataFrame:
        """Alerts of each station's latest reading."""
        return filters.by_severity(explode_alerts(self._latest(province=province)), severity)

    def compare(self, station_id: str) -> DataFrame:
        """Latest reading against the baseline; empty when either is missing."""
        return self._compare(_required(station_id))

    def compare_all(self) -> DataFrame:
        return self._compare(None)

    def _compare(self, station_id: str | None) -> DataFrame:
        baseline = filters.match_optional(self.summary_rows, station_id=station_id)
        joined = joins.current_against_baseline(self._latest(station_id), baseline)
        return compare_columns(joined)

    def provinces_table(
        self,
        region: str | None = None,
        query: str | None = None,
        field: str = "aqi_value",
        direction: str = "desc",
    ) -> DataFrame:
        """The live all-provinces table: filtered, sorted and ranked."""
        shown = filters.search(projections.display_shape(self._latest()), region, query)
        return ranking.rank_by(shown, field, direction)

    def last_updated(self) -> DataFrame:
        return rollups.last_updated(self.realtime_rows)

    def city_card(self, station_id: str) -> DataFrame:
        """One station's latest values with category and anomaly flag."""
        return self._card(_required(station_id))

    def city_cards(self) -> DataFrame:
        return self._card(None)

    def _card(self, station_id: str | None) -> DataFrame:
        cities = self.registry.select("station_id", "city_id", F.col("province").alias("city_name"))
        shown = projections.display_shape(self._latest(station_id)).join(cities, "station_id")
        return shown.select(
            "city_id",
            "city_name",
            "temp",
            "humidity",
            "pm2_5",
            "aqi_value",
            "aqi_category",
            "is_anomaly",
            "timestamp",
        )

    def city_compare(self, city_id: int | None = None) -> DataFrame:
        """``compare`` by city, with the baseline's index and the index deviation; of one city where it is named."""
        historical = rules.pm25_to_aqi("historical_avg_pm25", "null")
        cities = self.registry.select("station_id", "city_id", F.col("province").alias("_city"))
        if city_id is not None:
            cities = cities.where(F.col("city_id") == city_id)
        return (
            self.compare_all()
            .join(cities, "station_id")
            .select(
                "city_id",
                F.coalesce("province", "_city").alias("city_name"),
                "current_temp",
                "historical_avg_temp",
                "temp_deviation",
                "current_aqi",
                historical.alias("historical_avg_aqi"),
                (F.col("current_aqi") - historical).alias("aqi_deviation"),
            )
        )

    def city_alerts(self, severity: str = "all", city_id: int | None = None) -> DataFrame:
        """``alerts`` with city id, display type and threshold; of one city's province where it is named.

        A city that is not registered has no alerts.
        """
        shown, threshold = rules.alert_display("alert_type", "level")
        alerts = self.alerts(severity=severity)
        if city_id is not None:
            province = self.registry.where(F.col("city_id") == city_id).select("province").distinct()
            alerts = alerts.join(province, "province", "left_semi")
        return joins.with_city(alerts, self.registry).select(
            "city_id",
            F.col("province").alias("city_name"),
            shown.alias("alert_type"),
            "value",
            threshold.alias("threshold_exceeded"),
            "timestamp",
        )

    def city_stats(self, how: str = "fixed") -> dict[str, DataFrame]:
        """``stats`` by city, pollution as an index; the lists keep their order and carry it as ``rank``."""

        def rows(metric: str) -> DataFrame:
            aqi = rules.pm25_to_aqi("avg_pm25", "null")
            top = ranking.rank_bounded(self.top_stations(metric), F.desc_nulls_last(metric), "station_id")
            ranked = joins.with_city(top, self.registry).select(
                "rank",
                "city_id",
                F.col("province").alias("city_name"),
                F.col("avg_temp").alias("temp"),
                aqi.alias("aqi"),
            )
            return ranked.orderBy("rank")

        national = self.national(how).select(
            "national_avg_temp",
            rules.pm25_to_aqi("national_avg_pm25", "null").alias("national_avg_aqi"),
        )
        return {
            "top_hottest_cities": rows("avg_temp"),
            "top_polluted_cities": rows("avg_pm25"),
            "national": national,
        }
