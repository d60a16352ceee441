"""Ranking of sites, field records, run history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.functions.rules import QUOTAS, verdict
from fluvia.operators.regions import written
from fluvia.operators.spatial import nearest_within


def quota_top(sites: DataFrame, score: str, key: str, source: str = "source", quotas: dict[str, int] = QUOTAS, n: int = 50) -> DataFrame:
    """The best of each source up to its quota, filled up to n with the best of the rest, ranked from 1; ties by key."""
    own = Window.partitionBy(source).orderBy(F.desc(score), key)
    quota = F.coalesce(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col(source)], F.lit(0))
    # no more than the n best of a source can be chosen
    best = sites.withColumn("_own", F.row_number().over(own)).where(F.col("_own") <= n).withColumn("_in", F.col("_own") <= quota)
    chosen = best.orderBy(F.desc("_in"), F.desc(score), key).limit(n)
    return chosen.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), key))).drop("_own", "_in")


def candidates(sites: DataFrame, score: str, key: str, n: int = 50) -> DataFrame:
    """The best max(6 n, 300) with a positive score, before any costly join."""
    return sites.where(F.col(score) > 0).orderBy(F.desc(score), key).limit(max(6 * n, 300))


def _met(sites: DataFrame, records: DataFrame, d: float, more: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(site_id, record_id, more columns of the record) of records that name a site, and the same with d2 of the nearest ones of the other sites."""
    r = records.where(F.col("px").isNotNull() & F.col("py").isNotNull())
    # written, so that Spark knows how small they are before it deals the sites out
    claims = written(r.where("claimed is not null").select(F.col("claimed").alias("site_id")).distinct())
    listed = written(sites.join(claims, "site_id", "left_semi").select("site_id").distinct())
    named = r.join(listed.withColumnRenamed("site_id", "claimed"), "claimed", "left_semi")
    free = r.join(named.select("record_id"), "record_id", "left_anti")
    near = nearest_within(sites.join(listed, "site_id", "left_anti"), free, "site_id", "record_id", d, more=more)
    return named.select(F.col("claimed").alias("site_id"), "record_id", *more), near


def field_matches(sites: DataFrame, records: DataFrame, d: float = 300.0) -> DataFrame:
    """(site_id, record_id): records that name a site; for sites that none names, the nearest within d of records that name no listed site."""
    exact, near = _met(sites, records, d)
    best = near.groupBy("site_id").agg(F.min(F.struct("d2", "record_id")).alias("r"))
    return exact.unionByName(best.select("site_id", "r.record_id"))


def field_status(sites: DataFrame, records: DataFrame, d: float = 300.0) -> DataFrame:
    """(site_id, visits, verdict): of the records that match a site as in field_matches, the latest by date decides.

    Records have one row an id. They bring what decides along, so that matches and visits come from one aggregate.
    """
    decides = ("reference_class", "erosion_present")
    exact, near = _met(sites, records, d, ("today", *decides))
    every = exact.withColumn("d2", F.lit(None).cast("double")).unionByName(near)
    named = F.col("d2").isNull()
    last = F.max_by(F.when(named, F.struct(*decides)), F.when(named, F.struct("today", "record_id"))).alias("last")
    got = every.groupBy("site_id").agg(F.count_if(named).alias("n"), last, F.min(F.when(~named, F.struct("d2", "record_id", *decides))).alias("near"))
    r = [F.when(F.col("n") > 0, F.col(f"last.{c}")).otherwise(F.col(f"near.{c}")) for c in decides]
    visits = F.when(F.col("n") > 0, F.col("n")).otherwise(1).alias("visits")
    return got.join(sites.select("site_id", "site_class"), "site_id").select("site_id", visits, verdict(F.col("site_class"), *r).alias("verdict"))


def field_summary(status: DataFrame) -> DataFrame:
    yes, no = F.count_if(F.col("verdict") == "Confirmed"), F.count_if(F.col("verdict") == "Not confirmed")
    return status.agg(F.count(F.lit(1)).alias("visited"), yes.alias("confirmed"), no.alias("not_confirmed"), F.round(F.try_divide(yes, yes + no), 3).alias("rate"))


def field_report(records: DataFrame, sites: DataFrame) -> DataFrame:
    """One row: records, those with coordinates, sites visited, confirmed and not, the rate over decided ones, how many records agree with the map (of all), and new sites."""
    status = field_summary(field_status(sites, records))
    gps = F.col("px").isNotNull() & F.col("py").isNotNull()
    agrees = F.avg((F.lower(F.coalesce("map_agrees", F.lit(""))) == "yes").cast("double"))
    r = records.agg(F.count(F.lit(1)).alias("records"), F.count_if(gps).alias("records_with_gps"), F.round(agrees, 3).alias("map_agreement"), F.count_if(F.coalesce("claimed", F.lit("")) == "NEW").alias("new_sites"))
    return r.crossJoin(F.broadcast(status))  # one row


def field_by_type(sites: DataFrame, status: DataFrame) -> DataFrame:
    """(site_class, visited, confirmed) of the classes that were visited."""
    return status.join(sites.select("site_id", "site_class"), "site_id").groupBy("site_class").agg(F.count(F.lit(1)).alias("visited"), F.count_if(F.col("verdict") == "Confirmed").alias("confirmed"))


def trend(history: DataFrame, day: str, coverage: str, least: float = 60.0) -> DataFrame:
    """Runs by their day, with a flag for low coverage."""
    return history.withColumn("low_confidence", F.col(coverage) < least).orderBy(day)


def latest_reports(reports: DataFrame, day: str, n: int = 7) -> DataFrame:
    """The latest report and the ones before it."""
    return reports.orderBy(F.desc(day)).limit(n)


def due(last: Column, today: Column, days: int = 13) -> Column:
    """Whether a new report is due; without a last one it is."""
    return F.coalesce(F.datediff(today, last) >= days, F.lit(True))


def differences(now: DataFrame, before: DataFrame, key: str, value: str, digits: int = 1) -> DataFrame:
    """(key, now, before, change) of two editions; one that lacks a key has 0."""
    both = now.select(key, F.col(value).alias("now")).join(before.select(key, F.col(value).alias("before")), key, "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return both.select(key, zero("now").alias("now"), zero("before").alias("before"), F.round(zero("now") - zero("before"), digits).alias("change"))


def next_unlabelled(points: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """The first point that nobody labelled."""
    return points.join(labels.where("label is not null").select(key), key, "left_anti").orderBy(key).limit(1)


def upsert(history: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """History without the keys of new, and new; columns that one lacks are NULL."""
    return history.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def counted(rows: DataFrame, label: str, order: list[str]) -> DataFrame:
    """(label, place, n) of every label in a fixed order, 0 where none has it."""
    spark = rows.sparkSession
    table = spark.range(len(order)).select(F.col("id").cast("int").alias("place"), F.element_at(F.array(*[F.lit(x) for x in order]), (F.col("id") + 1).cast("int")).alias(label))
    n = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return table.join(n, label, "left").select(label, "place", F.coalesce("n", F.lit(0)).alias("n"))


def site_label(site: Column, cls: Column, place: Column) -> Column:
    return F.concat(site, F.lit(": "), F.substring_index(cls, " (", 1), F.coalesce(F.concat(F.lit(" near "), place), F.lit("")))
