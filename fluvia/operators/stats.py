"""Tests of change and resampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.functions.special import hypergeometric_upper, normal_quantile_upper, normal_upper, student_upper
from fluvia.operators.regions import written

#: Least variance of a water fraction, least dates, quantiles of the detection limit.
VARIANCE_FLOOR, LEAST_DATES = 0.05**2, 3
DETECTION = 1.959963984540054 + 0.8416212335729143


def running(rows: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> tuple[DataFrame, dict[str, float]]:
    """Adds running sums (name: of column) in an order over all rows, and gives the totals.

    Rows are dealt to partitions by ranges of the order; each is summed by
    itself, and what the driver holds is one row a partition.
    """
    parts = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    per = {r["_part"]: r for r in parts.groupBy("_part").agg(*[F.sum(c).alias(k) for k, c in sums.items()]).collect()}
    before, total = [], dict.fromkeys(sums, 0)
    for k in sorted(per):
        before.append((k, *total.values()))
        total = {c: v + (per[k][c] or 0) for c, v in total.items()}
    if not before:
        return parts.drop("_part").select("*", *[F.lit(0).alias(k) for k in sums]), total
    kinds = ", ".join(f"_b_{k} {parts.agg(F.sum(c)).schema[0].dataType.simpleString()}" for k, c in sums.items())
    offsets = rows.sparkSession.createDataFrame(before, f"_part int, {kinds}")
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = parts.join(F.broadcast(offsets), "_part")  # a row a partition
    return out.select(*rows.columns, *[(F.sum(c).over(w) + F.col(f"_b_{k}")).alias(k) for k, c in sums.items()]), total


def quantiles(rows: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation, from running counts of distinct values; the driver holds two values for each."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_k"))
    ranked, total = running(counts, [F.col(value)], {"_c": "_k"})
    n = total["_c"]
    if not n:
        return [None] * len(shares)
    places = [(n - 1) * s for s in shares]
    wanted = sorted({int(x) for p in places for x in (math.floor(p), math.ceil(p))})
    hit = [(F.col("_c") - F.col("_k") <= w) & (F.col("_c") > w) for w in wanted]
    any_hit = hit[0]
    for h in hit[1:]:
        any_hit = any_hit | h
    got = ranked.where(any_hit).select(F.col(value).cast("double").alias("v"), (F.col("_c") - F.col("_k")).alias("low"), F.col("_c").alias("high")).collect()
    at = lambda w: next(r.v for r in got if r.low <= w < r.high)
    return [at(math.floor(p)) + (at(math.ceil(p)) - at(math.floor(p))) * (p - math.floor(p)) for p in places]


def welch(na: Column, ma: Column, va: Column, nb: Column, mb: Column, vb: Column) -> dict[str, Column]:
    """d = b - a, its standard error, t and degrees of freedom; NULL under three values on either side."""
    fa, fb = (F.greatest(F.coalesce(v, F.lit(0.0)), F.lit(VARIANCE_FLOOR)) / n for v, n in ((va, na), (vb, nb)))
    enough = (na >= LEAST_DATES) & (nb >= LEAST_DATES)
    se2 = fa + fb
    df = se2 * se2 / (fa * fa / (na - 1) + fb * fb / (nb - 1))
    d = mb - ma
    return {"d": F.when(enough, d), "se": F.when(enough, F.sqrt(se2)), "t": F.when(enough, d / F.sqrt(se2)), "df": F.when(enough, df)}


def tested(rows: DataFrame) -> DataFrame:
    """rows with t, df: adds p_up and p_two."""
    return rows.withColumn("p_up", student_upper("t", "df")).withColumn("p_two", 2 * F.least(F.col("p_up"), 1 - F.col("p_up")))


def benjamini_hochberg(rows: DataFrame, p: str, q: float = 0.05) -> DataFrame:
    """Adds rejected. Ranks come from counts of distinct p-values, ties share the last; the cut is one value."""
    counts = rows.where(F.col(p).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("_n"))
    ranked, total = running(counts, [F.col(p)], {"_rank": "_n"})
    cut = ranked.where(F.col(p) * F.lit(float(total["_rank"])) <= q * F.col("_rank")).agg(F.max(p).alias("_cut"))
    return rows.crossJoin(F.broadcast(cut)).withColumn("rejected", F.coalesce(F.col(p) <= F.col("_cut"), F.lit(False))).drop("_cut")  # one row


def stouffer(rows: DataFrame, key: str, p_up: str, deflate: float = 2.0) -> DataFrame:
    """(key, k, p): patches' joint one-sided p, pixels' z summed and divided by deflate * sqrt(k)."""
    z = rows.withColumn("_z", normal_quantile_upper(F.greatest(F.col(p_up), F.lit(1e-300))))
    sums = z.groupBy(key).agg(F.count("_z").alias("k"), F.sum("_z").alias("_s"))
    return sums.withColumn("p", normal_upper(F.col("_s") / (deflate * F.sqrt("k")))).drop("_s")


def fisher(ka: Column, na: Column, kb: Column, nb: Column) -> dict[str, Column]:
    """One-sided tails that b has more (up) or fewer (down), and the doubled smaller one."""
    up = F.least(hypergeometric_upper(kb, na + nb, ka + kb, nb), F.lit(1.0))
    down = F.least(1 - hypergeometric_upper(kb + 1, na + nb, ka + kb, nb), F.lit(1.0))
    return {"p_up": up, "p_down": down, "p_two": F.least(F.lit(1.0), 2 * F.least(up, down))}


def detection_limit(se: Column, pixel_m2: float = 100.0) -> Column:
    return DETECTION * se * pixel_m2


def _resampled(groups: DataFrame, sums: Sequence[str], rounds: int, seed: int) -> DataFrame:
    """Sums of resampled groups, a row a round. A draw is a Poisson(1) weight by hash of the round, the row and its number among equal rows: no row needs another, and the number of rows drawn varies by its square root."""
    every = groups.columns
    numbered = groups.withColumn("_nth", F.row_number().over(Window.partitionBy(*every).orderBy(F.lit(0))))
    rows = numbered.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    u = (F.pmod(F.xxhash64("_b", "_nth", *every, F.lit(seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    weight, below, term = F.lit(0), 0.0, math.exp(-1)
    for k in range(9):
        below += term
        weight = weight + F.when(u > below, 1).otherwise(0)
        term /= k + 1
    return rows.withColumn("_w", weight).groupBy("_b").agg(*[F.sum(F.col(c) * F.col("_w")).alias(c) for c in sums])


def bootstrap(groups: DataFrame, sums: Sequence[str], ratio: Column, rounds: int = 1000, seed: int = 42) -> DataFrame:
    """(low, high, mean) of a ratio of sums over resampled groups; percentiles are of ``rounds`` rows."""
    per = _resampled(groups, sums, rounds, seed).withColumn("_v", ratio)
    return per.agg(F.percentile("_v", F.lit(0.025)).alias("low"), F.percentile("_v", F.lit(0.975)).alias("high"), F.avg("_v").alias("mean"))


def bootstrap_difference(groups: DataFrame, sums: Sequence[str], first: Column, second: Column, rounds: int = 1000, seed: int = 42) -> DataFrame:
    """(mean, low, high, share_positive) of the difference of two ratios over the same draws."""
    per = _resampled(groups, sums, rounds, seed).withColumn("_v", first - second)
    return per.agg(F.avg("_v").alias("mean"), F.percentile("_v", F.lit(0.025)).alias("low"), F.percentile("_v", F.lit(0.975)).alias("high"), F.avg((F.col("_v") > 0).cast("double")).alias("share_positive"))


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, rho): correlation of ranks, ties sharing their mean rank. Ranks come from running counts of distinct values."""
    both = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())

    def ranks(c: str) -> DataFrame:
        counts, _ = running(both.groupBy(c).agg(F.count(F.lit(1)).alias("_k")), [F.col(c)], {"_c": "_k"})
        return counts.select(c, (F.col("_c") - F.col("_k") + (F.col("_k") + 1) / 2).alias(f"r_{c}"))

    ranked = both.join(ranks(x), x).join(ranks(y), y)
    return ranked.agg(F.count(F.lit(1)).alias("n"), F.corr(f"r_{x}", f"r_{y}").alias("rho"))


def spearman_test(rows: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, rho, p): the two-sided p of Student's t with n - 2 degrees of freedom; NULL under three rows."""
    t = F.abs("rho") * F.sqrt((F.col("n") - 2) / (1 - F.col("rho") * F.col("rho")))
    s = spearman(rows, x, y).withColumn("_t", F.when((F.col("n") > 2) & (F.abs("rho") < 1), t)).withColumn("_df", (F.col("n") - 2).cast("double"))
    return s.withColumn("p", F.when(F.abs("rho") >= 1, 0.0).otherwise(2 * student_upper("_t", "_df"))).drop("_t", "_df")


def roc_auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """One row (auc): Mann-Whitney over distinct scores, ties half."""
    c = rows.groupBy(score).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("n"))
    ranked, _ = running(c, [F.col(score)], {"_upto": "n"})
    return ranked.withColumn("w", F.col("p") * (F.col("_upto") - F.col("n") / 2)).agg((F.sum("w") / (F.sum("p") * F.sum("n"))).alias("auc"))


def average_precision(rows: DataFrame, score: str, label: str) -> DataFrame:
    c = rows.groupBy(score).agg(F.sum(label).alias("p"), F.count(F.lit(1)).alias("k"))
    ranked, _ = running(c, [F.desc(score)], {"_p": "p", "_n": "k"})
    return ranked.withColumn("a", F.col("p") * F.col("_p") / F.col("_n")).agg((F.sum("a") / F.sum("p")).alias("average_precision"))


def captured(rows: DataFrame, score: str, label: str, share: int, tie: str) -> DataFrame:
    """One row (captured): positives among the int(n * share / 100) highest scores."""
    ranked, total = running(rows.select(score, tie, label).withColumn("_one", F.lit(1)), [F.desc(score), F.col(tie)], {"_rank": "_one"})
    top = F.sum(F.when(F.col("_rank") <= int(total["_rank"]) * share // 100, F.col(label)).otherwise(0))
    return ranked.agg(top.alias("t"), F.sum(label).alias("p")).select(F.when(F.col("p") > 0, F.col("t") / F.col("p")).alias("captured"))


def bins(x: Column, edges: Sequence[float]) -> Column:
    """The number from 0 of the bin [low, high) that x is in, the last one closed; NULL outside."""
    out = F.when(x == edges[-1], len(edges) - 2)
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        out = out.when((x >= low) & (x < high), k)
    return out


def stratified_sample(rows: DataFrame, stratum: str, key: str, each: int, seed: int = 42) -> DataFrame:
    """Exactly ``each`` rows of a stratum (all of a smaller one) in the order of a hash, with blind ids."""
    w = Window.partitionBy(stratum).orderBy(F.xxhash64(key, F.lit(seed)), key)
    drawn = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= each).drop("_n")
    return drawn.withColumn("id", F.format_string("P%03d", F.row_number().over(Window.orderBy(F.xxhash64(key, F.lit(seed + 1)), key))))
