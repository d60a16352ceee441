"""Sensor alerts: rules over readings (station, ts, value), in batch and as a stream.

Frames are spans of time. A missing reading raises no alert of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.operators.regions import written

#: Thresholds of the rules (mm, m, kPa, per cent, degrees, hours, volts), and severities from the worst.
RAIN_24H, RISE_6H, FALL_6H = 64.5, 1.0, -0.5
PORE_EXCESS, PORE_RISE_24H, WATER_KPA_M, TIP_BELOW_WARNING = 10.0, 5.0, 9.81, 5.0
SOIL_PCT, BATTERY_V, SILENT_HOURS = 45.0, 3.5, 2
TILT, TILT_24H, TILT_SLOW = 10.0, 3.0, 1.0
SEVERITY = {"critical": 3, "warning": 2, "watch": 1, "info": 0}
LATE = "2 hours"


def _trailing(hours: int) -> Window:
    return Window.partitionBy("station").orderBy(F.unix_micros("ts")).rangeBetween(-hours * 3_600_000_000 + 1, 0)


def trailing_sum(readings: DataFrame, hours: int = 24) -> DataFrame:
    """Adds total: the sum over the last hours, this reading included."""
    return readings.withColumn("total", F.sum("value").over(_trailing(hours)))


def lagged_change(readings: DataFrame, hours: int = 6) -> DataFrame:
    """Adds change: this value less the latest one at least so many hours ago; NULL where there is none."""
    w = Window.partitionBy("station").orderBy(F.unix_micros("ts")).rangeBetween(Window.unboundedPreceding, -hours * 3_600_000_000)
    return readings.withColumn("change", F.col("value") - F.last("value", ignorenulls=True).over(w))


def forward_asof(main: DataFrame, other: DataFrame) -> DataFrame:
    """(station, ts, event_id, main_ts): each other reading with the first main reading at or after it, else the last before."""
    both = main.select("station", "ts", F.col("ts").alias("main_ts"), F.lit(None).cast("long").alias("event_id"), F.lit(1).alias("k")).unionByName(other.select("station", "ts", F.lit(None).cast("timestamp").alias("main_ts"), "event_id", F.lit(0).alias("k")))
    w = Window.partitionBy("station").orderBy("ts", "k")
    ahead = F.first("main_ts", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    behind = F.last("main_ts", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("at", F.coalesce(ahead, behind)).where("k = 0").select("station", "ts", "event_id", F.col("at").alias("main_ts"))


def rules(rain: Column, change: Column, level: Column, warning_level: Column) -> Column:
    """array of struct(severity, rule), worst first."""
    alert = lambda when, severity, rule: F.when(when, F.struct(F.lit(SEVERITY[severity]).alias("rank"), F.lit(severity).alias("severity"), F.lit(rule).alias("rule")))
    found = F.array(alert(rain >= RAIN_24H, "warning", "rain_24h"), alert(change <= FALL_6H, "warning", "level_fall_6h"), alert(change >= RISE_6H, "watch", "level_rise_6h"), alert(level >= warning_level, "warning", "level_high"))
    return F.reverse(F.array_sort(F.filter(found, lambda a: a.isNotNull())))


def tilt_rules(tilt: Column, change_24h: Column, silent: Column) -> Column:
    """Severity of a tilt node: silent nodes that had moved are the worst."""
    moved = F.coalesce((tilt >= TILT) | (change_24h >= TILT_24H), F.lit(False))
    return F.when(silent & moved, "critical").when(silent, "info").when(tilt >= TILT, "critical").when(change_24h >= TILT_24H, "warning").when(change_24h >= TILT_SLOW, "watch")


def pore_rules(excess: Column, rise_24h: Column) -> Column:
    return F.when(excess >= PORE_EXCESS, "warning").when(rise_24h >= PORE_RISE_24H, "watch")


def latest(readings: DataFrame) -> DataFrame:
    """(station, metric, setback, ts, value, low_24h, sum_24h, before_6h): each series' last reading with a value, and its least value, sum and the latest value at least six hours old, by time."""
    key = ["station", "metric", "setback"]
    r = readings.where(F.col("value").isNotNull()).withColumn("setback", F.coalesce("setback", F.lit(0)))
    last = r.groupBy(*key).agg(F.max("ts").alias("last"))
    age = F.unix_micros("last") - F.unix_micros("ts")
    hours = lambda n: n * 3_600_000_000
    at = F.struct("ts", "event_id")
    return r.join(last, key).withColumn("age", age).groupBy(*key).agg(
        F.max("ts").alias("ts"), F.max_by("value", at).alias("value"), F.min(F.when(F.col("age") < hours(24), F.col("value"))).alias("low_24h"), F.sum(F.when(F.col("age") < hours(24), F.col("value"))).alias("sum_24h"),
        F.max_by(F.when(F.col("age") >= hours(6), F.col("value")), F.when(F.col("age") >= hours(6), at)).alias("before_6h"),
    )


def evaluated(stations: DataFrame, readings: DataFrame, now: Column) -> DataFrame:
    """(station, rule, setback, severity, rank, value): all alerts at one time.

    stations: station, level_warning_m, piezo_tip_m (five metres under the
    warning level where NULL), setbacks (of its tilt nodes). readings: station,
    ts, event_id, metric, setback, value. Spans are of time up to a series' last
    reading; a missing value raises nothing. A station without readings has one
    alert; a node without is told as well.
    """
    l = written(latest(readings))  # noqa: E741
    series = lambda m, *cols: l.where(F.col("metric") == m).select("station", *cols)
    heard = l.select("station").distinct()
    alert = lambda rule, severity, value, setback=None: F.struct(F.lit(rule).alias("rule"), (F.col(setback) if setback else F.lit(None)).cast("int").alias("setback"), (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"), value.cast("double").alias("value"))
    raised = lambda df, *tests: df.select("station", F.explode(F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), a) for t, a in tests]), lambda a: a.isNotNull())).alias("a"))

    level = series("level_m", F.col("value").alias("level"), (F.col("value") - F.col("before_6h")).alias("change"))
    of = stations.join(level, "station")
    out = [raised(
        of, (F.col("change") <= FALL_6H, alert("level_fall_6h", "warning", F.col("change"))), (F.col("change") >= RISE_6H, alert("level_rise_6h", "watch", F.col("change"))),
        (F.col("level") >= F.col("level_warning_m"), alert("level_high", "warning", F.col("level"))),
    )]
    out.append(raised(series("rain_mm", "sum_24h"), (F.col("sum_24h") >= RAIN_24H, alert("rain_24h", "warning", F.col("sum_24h")))))
    tip = F.coalesce("piezo_tip_m", F.col("level_warning_m") - TIP_BELOW_WARNING)
    pore = of.join(series("pore_kpa", F.col("value").alias("pore"), (F.col("value") - F.col("low_24h")).alias("rise")), "station").withColumn("excess", F.col("pore") - WATER_KPA_M * (F.col("level") - tip))
    high = F.col("excess") >= PORE_EXCESS
    out.append(raised(pore.withColumn("s", pore_rules(F.col("excess"), F.col("rise"))), (F.col("s").isNotNull(), alert("pore", F.col("s"), F.when(high, F.col("excess")).otherwise(F.col("rise"))))))
    out.append(raised(series("soil_30", "value"), (F.col("value") >= SOIL_PCT, alert("soil_wet", "watch", F.col("value")))))
    out.append(raised(series("battery_v", "value"), (F.col("value") < BATTERY_V, alert("battery_low", "info", F.col("value")))))
    nodes = stations.join(heard, "station", "left_semi").select("station", F.explode("setbacks").alias("setback"))
    tilt = nodes.join(l.where("metric = 'tilt'").select("station", "setback", F.col("value").alias("tilt"), "ts", (F.col("value") - F.col("low_24h")).alias("change")), ["station", "setback"], "left")
    silent = F.unix_micros(now) - F.unix_micros("ts") > SILENT_HOURS * 3_600_000_000
    severity = F.when(F.col("tilt").isNull(), "warning").otherwise(tilt_rules(F.col("tilt"), F.col("change"), silent))
    out.append(raised(tilt.withColumn("s", severity), (F.col("s").isNotNull(), alert("tilt", F.col("s"), F.col("tilt"), "setback"))))
    out.append(raised(stations.join(heard, "station", "left_anti"), (F.lit(True), alert("no_data", "warning", F.lit(None)))))
    every = out[0]
    for o in out[1:]:
        every = every.unionByName(o)
    rank = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])[F.col("severity")]
    return every.select("station", "a.*").withColumn("rank", rank).select("station", "rule", "setback", "severity", "rank", "value")


def statuses(stations: DataFrame, alerts: DataFrame) -> DataFrame:
    """(station, status, n_alerts): the worst severity of each station, normal without alerts."""
    worst = alerts.groupBy("station").agg(F.max_by("severity", "rank").alias("severity"), F.count(F.lit(1)).alias("n"))
    return stations.select("station").join(worst, "station", "left").select("station", F.coalesce("severity", F.lit("normal")).alias("status"), F.coalesce("n", F.lit(0)).alias("n_alerts"))


def stations(readings: DataFrame, warning: Column) -> DataFrame:
    """(station, rain, change, level, status, n_alerts) at each station's last reading."""
    x = lagged_change(trailing_sum(readings))
    last = x.groupBy("station").agg(F.max_by(F.struct("total", "change", "value"), F.struct("ts", "event_id")).alias("l"))
    alerts = rules(F.col("l.total"), F.col("l.change"), F.col("l.value"), warning)
    return last.withColumn("alerts", alerts).select("station", F.col("l.total").alias("rain"), F.col("l.change").alias("change"), F.col("l.value").alias("level"), F.when(F.size("alerts") > 0, F.element_at("alerts", 1)["severity"]).otherwise("normal").alias("status"), F.size("alerts").alias("n_alerts"))


def heavy(key, frames, state):
    """State of applyInPandasWithState: a station's readings of the last 24 hours; tells each new reading whose trailing sum reaches the limit."""
    import pandas as pd

    day = 86_400_000
    held = dict(zip(zip(*state.get[:2], strict=True), state.get[2], strict=True)) if state.exists else {}
    new = []
    for f in frames:
        for ts, event, value in zip(f["ts"], f["event_id"], f["value"], strict=True):
            at = int(pd.Timestamp(ts).timestamp() * 1000), int(event)
            if at not in held and value == value:
                held[at] = float(value)
                new.append(at)
    told = []
    first = min((t for t, _ in new), default=0)
    for t, _ in sorted({(t, 0) for t, _ in held if t >= first}) if new else []:  # a late reading counts in the sums after it
        total = sum(v for (u, _), v in held.items() if t - day < u <= t)
        if total >= RAIN_24H:
            told.append((key[0], pd.Timestamp(t, unit="ms"), total))
    old = state.getCurrentWatermarkMs() - day
    held = {k: v for k, v in held.items() if k[0] > old}
    state.update(([t for t, _ in held], [e for _, e in held], list(held.values())))
    if told:
        yield pd.DataFrame(told, columns=["station", "until", "rain"])


def rain_alerts(stream: DataFrame) -> DataFrame:
    """Streaming: trailing 24-hour sums at each reading that reach the limit, as the batch form has them. A reading may be two hours late; repeated ones (by event_id) count once."""
    plain = stream.withWatermark("ts", LATE).select("station", "event_id", "ts", "value")
    return plain.groupBy("station").applyInPandasWithState(heavy, "station long, until timestamp, rain double", "ts array<long>, id array<long>, value array<double>", "append", "NoTimeout")


def silent(key, frames, state):
    """State of applyInPandasWithState: a station that sends nothing for two hours of event time is told once."""
    import pandas as pd

    if state.hasTimedOut:
        (last,) = state.get
        state.remove()
        yield pd.DataFrame({"station": [key[0]], "last_ts": [pd.Timestamp(last, unit="ms")]})
        return
    last = state.get[0] if state.exists else 0
    for f in frames:
        last = max(last, int(f["ts"].max().timestamp() * 1000))
    state.update((last,))
    state.setTimeoutTimestamp(max(last + 2 * 3_600_000, state.getCurrentWatermarkMs() + 1))


def silent_stations(stream: DataFrame) -> DataFrame:
    return stream.withWatermark("ts", LATE).groupBy("station").applyInPandasWithState(silent, "station long, last_ts timestamp", "last long", "append", "EventTimeTimeout")
