"""Numeric helpers: averages, rounding, exact quantiles at any size.

Averages are double averages snapped to 9 decimals before they are rounded: the
snap absorbs the last-bit differences that the order of partial sums leaves,
and every digit of the input counts. Quantiles are found in two passes over the
data: a sketch brackets the wanted ranks, then the values inside are counted.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.session import work_dir

SNAP = 9
BUCKETS = 1024
#: Size of the KLL sketches (rank error below 0.1 %) and how far a bracket reaches beyond the wanted rank.
SKETCH_K, SLACK = 4000, 0.004
#: Expected rows in brackets up to which the driver takes their counted values, or one task orders a group's.
COLLECTED, ORDERED = 100_000, 1_000_000
#: Fixed value: the largest finite double; infinities are narrowed as if they were this.
BIGGEST = 1.7976931348623157e308


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c) -> Column:
    """The value as double; NaN and infinities count as missing (NULL)."""
    x = _c(c).cast("double")
    return F.when(F.abs(x) <= F.lit(BIGGEST), x)


def snapped(x: Column, digits: int) -> Column:
    """``round(x, digits)`` after snapping to ``SNAP`` decimals."""
    return F.round(F.round(x, SNAP), digits)


def rounded_avg(c, digits: int) -> Column:
    return snapped(F.avg(_c(c).cast("double")), digits)


def rounded_stddev(c, digits: int) -> Column:
    """Sample standard deviation (NULL for one row)."""
    return snapped(F.stddev_samp(_c(c).cast("double")), digits)


def interpolate(lo: float, hi: float, pos: float) -> float:
    """Linear interpolation between neighbouring order statistics."""
    lower, higher = math.floor(pos), math.ceil(pos)
    if lower == higher or lo == hi:
        return lo
    return (higher - pos) * lo + (pos - lower) * hi


def _clamped(c) -> Column:
    x = F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))
    return F.when(x > BIGGEST, F.lit(BIGGEST)).when(x < -BIGGEST, F.lit(-BIGGEST)).otherwise(x)


def _bucket(v: Column, lo: Column, hi: Column) -> Column:
    """Which of ``BUCKETS`` equal parts of [lo, hi] holds ``v`` (halves keep the width finite)."""
    part = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2) * F.lit(float(BUCKETS))
    return F.when(v >= hi, F.lit(BUCKETS - 1)).otherwise(
        F.least(F.coalesce(F.floor(part).cast("int"), F.lit(0)), F.lit(BUCKETS - 1)))


def _unclamped(v: float) -> float:
    return math.copysign(math.inf, v) if abs(v) >= BIGGEST else v


def _sketched(col: Column, n: Column, q: float) -> tuple[Column, Column]:
    """A value at or below, and one at or above, the wanted ranks: quantiles of a KLL sketch, ``SLACK`` to either side."""
    sketch = F.kll_sketch_agg_double(col, F.lit(SKETCH_K))
    at = lambda p: F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(p)))
    lo = F.min(col) if q - SLACK <= 0 else at(q - SLACK)
    hi = F.max(col) if q + SLACK >= 1 else at(q + SLACK)
    return lo, hi


def exact_quantiles(df: DataFrame, cols: list[str], q: float, weight: str | None = None) -> dict[str, float | None]:
    """Exact linear-interpolated quantile of each of ``cols`` (NULL and NaN are left out).

    Two passes over the data for all columns together, whatever their values: a
    KLL sketch brackets the wanted ranks, then the values inside the brackets
    are counted exactly, with those below as one number. Brackets of at most
    ``COLLECTED`` expected rows come to the driver as (value, count); wider ones
    are written as a table of counted values, less than a hundredth of the
    data, and narrowed there. With ``weight`` a row stands for that many rows
    (a table of counted values), which is narrowed directly.
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    values = df.select(*[_clamped(c).alias(f"v{i}") for i, c in enumerate(cols)], w.alias("w"))
    if weight is not None:
        return dict(zip(cols, _narrow(values, len(cols), q), strict=True))
    aggs = []
    for i in range(len(cols)):
        n = F.count(f"v{i}")
        lo, hi = _sketched(F.col(f"v{i}"), n, q)
        aggs += [n.alias(f"n{i}"), lo.alias(f"lo{i}"), hi.alias(f"hi{i}")]
    st = values.agg(*aggs).first()
    some = [i for i in range(len(cols)) if st[f"n{i}"]]
    parts = [F.when(F.col(f"v{i}") < st[f"lo{i}"], F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("v")))
             .when(F.col(f"v{i}") <= st[f"hi{i}"], F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v"))) for i in some]
    out: dict[str, float | None] = dict.fromkeys(cols)
    if not some:
        return out
    cells = (values.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).groupBy("p.i", "p.v")
             .agg(F.count(F.lit(1)).alias("w")))
    if 3 * SLACK * sum(st[f"n{i}"] for i in some) > COLLECTED:
        path = work_dir(df.sparkSession, "quantile")
        cells.write.parquet(path)
        cells = df.sparkSession.read.parquet(path)
        below = {r["i"]: r["w"] for r in cells.where("v is null").collect()}
        inside = cells.where("v is not null").select(*[F.when(F.col("i") == i, F.col("v")).alias(f"v{k}")
                                                       for k, i in enumerate(some)], "w")
        found = _narrow(inside, len(some), q, [(st[f"n{i}"], below.get(i, 0)) for i in some])
    else:
        counted: dict[int, list] = {i: [] for i in some}
        for r in cells.collect():
            counted[r["i"]].append((r["v"], r["w"]))
        found = [picked(counted[i], st[f"n{i}"], q) for i in some]
    for i, x in zip(some, found, strict=True):
        # a rank outside its bracket (the sketch's error is random, far below SLACK): narrow the column itself
        out[cols[i]] = _narrow(values.select(F.col(f"v{i}").alias("v0"), "w"), 1, q)[0] if x is None else x
    return out


def picked(cells: list[tuple[float | None, int]], n: int, q: float) -> float | None:
    """The quantile of ``n`` values from those inside the bracket (the value None counts the ones below)."""
    pos = q * (n - 1)
    ends: list[float | None] = [None, None]
    acc = 0
    for v, w in sorted(cells, key=lambda c: (c[0] is not None, c[0])):
        for e, k in enumerate((math.floor(pos), math.ceil(pos))):
            if v is not None and acc <= k < acc + w:
                ends[e] = v
        acc += w
    lo, hi = ends
    return None if lo is None or hi is None else interpolate(_unclamped(lo), _unclamped(hi), pos)


def _narrow(values: DataFrame, n_cols: int, q: float, known: list[tuple[int, int]] | None = None) -> list[float | None]:
    """Quantiles of the weighted columns v0, v1, ... of ``values`` (weight w) by narrowing a histogram.

    ``known`` gives, per column, the count of all values and of those below the
    ones present. Each pass is one partially aggregated histogram job over the
    ranges that still hold a wanted rank; both ranks of all columns narrow
    together until a range is a single value. At most ``BUCKETS`` rows a column
    and rank reach the driver per pass, whatever the data or its ties. None
    where a rank is not among the values present.
    """
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        st = values.agg(*[f(F.col(f"v{i}")).alias(f"{name}{i}") for i in range(n_cols)
                          for f, name in ((lambda v: F.sum(F.when(v.isNotNull(), F.col("w"))), "n"), (F.min, "lo"), (F.max, "hi"))]
                        ).first()
        total = [known[i][0] if known else st[f"n{i}"] or 0 for i in range(n_cols)]
        start = [known[i][1] if known else 0 for i in range(n_cols)]
        ranks = [{math.floor(q * (n - 1)), math.ceil(q * (n - 1))} if n else set() for n in total]
        gone = {i for i in range(n_cols) for k in ranks[i]
                if not start[i] <= k < start[i] + (st[f"n{i}"] or 0)}
        # (column, rank) -> [lo, hi, rows below lo]
        state = {(i, k): [st[f"lo{i}"], st[f"hi{i}"], start[i]] for i in range(n_cols) if i not in gone for k in ranks[i]}
        while True:
            todo = [(key, s) for key, s in state.items() if s[0] < s[1]]
            if not todo:
                break
            parts = [F.when(F.col(f"v{i}").between(lo, hi), F.struct(
                F.lit(j).alias("j"), _bucket(F.col(f"v{i}"), F.lit(lo), F.lit(hi)).alias("b"), F.col(f"v{i}").alias("v")))
                for j, ((i, _), (lo, hi, _)) in enumerate(todo)]
            hist = (values.select("w", F.explode(F.array_compact(F.array(*parts))).alias("p")).groupBy("p.j", "p.b")
                    .agg(F.sum("w").alias("n"), F.min("p.v").alias("lo"), F.max("p.v").alias("hi")).collect())
            for j, ((_, k), s) in enumerate(todo):
                for row in sorted((r for r in hist if r["j"] == j), key=lambda r: r["b"]):
                    if k < s[2] + row["n"]:
                        s[0], s[1] = row["lo"], row["hi"]
                        break
                    s[2] += row["n"]
        out: list[float | None] = []
        for i in range(n_cols):
            pos = q * (total[i] - 1) if total[i] else 0
            out.append(interpolate(_unclamped(state[i, math.floor(pos)][0]), _unclamped(state[i, math.ceil(pos)][0]), pos)
                       if total[i] and i not in gone else None)
        return out
    finally:
        values.unpersist()


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    return exact_quantiles(df, [col], q)[col]


def quantiles_by(df: DataFrame, keys: list[str], cols: list[str], q: float) -> DataFrame:
    """Exact quantiles per group: ``keys`` and one column per name of ``cols``.

    The same two passes with the brackets in a table, one row a group: KLL
    sketches per group and column, then the counted values inside the brackets,
    written to the shared folder. Of a group of n rows about n / 100 counted
    values a column are left to order; where that is too many for one task, or
    a rank is outside its bracket, a histogram narrows them further.
    """
    spark = df.sparkSession
    at = [f"_k{i}" for i in range(len(keys))]
    src = df.select(*[F.col(k).alias(a) for k, a in zip(keys, at, strict=True)],
                    *[_clamped(c).alias(f"v{i}") for i, c in enumerate(cols)])
    aggs = []
    for i in range(len(cols)):
        n = F.count(f"v{i}")
        aggs += [n.alias(f"n{i}"), *[x.alias(f"{e}{i}") for e, x in zip(("lo", "hi"), _sketched(F.col(f"v{i}"), n, q),
                                                                         strict=True)]]
    path = work_dir(spark, "quantile")
    src.groupBy(*at).agg(*aggs).write.parquet(path)
    bounds = spark.read.parquet(path)
    same = [F.col(f"s.{a}").eqNullSafe(F.col(f"b.{a}")) for a in at]
    parts = []
    for i in range(len(cols)):
        v = F.col(f"s.v{i}")
        cell = lambda x, i=i: F.struct(F.lit(i).alias("f"), F.col(f"b.n{i}").alias("n"), x.alias("v"))
        parts.append(F.when(v < F.col(f"b.lo{i}"), cell(F.lit(None).cast("double"))).when(v <= F.col(f"b.hi{i}"), cell(v)))
    hit = (src.alias("s").join(bounds.alias("b"), same)
           .select(*[F.col(f"s.{a}") for a in at], F.explode(F.array_compact(F.array(*parts))).alias("p")))
    group = [*at, "_f"]
    path = work_dir(spark, "quantile")
    hit.groupBy(*at, F.col("p.f").alias("_f"), F.col("p.n").alias("n"), F.col("p.v").alias("v")) \
        .agg(F.count(F.lit(1)).alias("w")).write.parquet(path)
    cells = spark.read.parquet(path)
    pos = F.lit(q) * (F.col("n") - 1)
    first, last = F.floor(pos), F.ceil(pos)
    largest = bounds.agg(F.greatest(*[F.max(f"n{i}") for i in range(len(cols))], F.lit(0)).alias("n")).first()["n"] or 0
    if 3 * SLACK * largest <= ORDERED:
        run = Window.partitionBy(*group).orderBy(F.asc_nulls_first("v"))
        below = F.sum("w").over(run) - F.col("w")
        at_rank = lambda k: F.max(F.when((F.col("below") <= k) & (k < F.col("below") + F.col("w")), F.col("v")))
        ends = cells.withColumn("below", below).groupBy(*group, "n").agg(at_rank(first).alias("a"), at_rank(last).alias("b"))
    else:
        base = cells.groupBy(*group, "n").agg(F.sum(F.when(F.col("v").isNull(), F.col("w")).otherwise(0)).alias("below"),
                                              F.sum(F.when(F.col("v").isNotNull(), F.col("w")).otherwise(0)).alias("m"),
                                              F.min("v").alias("lo"), F.max("v").alias("hi"))
        ranks = base.withColumn("k", F.explode(F.array_distinct(F.array(first, last))))
        inside = ranks.where("below <= k and k < below + m").drop("m")
        ends = _ends(base.select(*group, "n"), _narrow_by(spark, cells.where("v is not null").select(*group, "v", "w"),
                                                          group, inside), group, q)
    path = work_dir(spark, "quantile")
    ends.write.parquet(path)
    ends = spark.read.parquet(path)
    lost = ends.where("a is null or b is null")
    if not lost.isEmpty():  # a rank outside its bracket: narrow all values of those groups
        items = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"v{i}").alias("v")) for i in range(len(cols))])
        long = src.select(*at, F.explode(items).alias("s")).select(
            *at, F.col("s.f").alias("_f"), F.col("s.v").alias("v"), F.lit(1).cast("long").alias("w")).where("v is not null")
        of = lost.select(*[F.col(g).alias(f"_y{g}") for g in group])
        long = long.join(of, [F.col(g).eqNullSafe(F.col(f"_y{g}")) for g in group], "left_semi")
        base = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        ranks = base.withColumn("below", F.lit(0).cast("long")).withColumn("k", F.explode(F.array_distinct(F.array(first, last))))
        ends = ends.where("a is not null and b is not null").unionByName(
            _ends(base.select(*group, "n"), _narrow_by(spark, long, group, ranks), group, q))
    inf = F.lit(float("inf"))
    real = lambda c: F.when(F.col(c) >= BIGGEST, inf).when(F.col(c) <= -BIGGEST, -inf).otherwise(F.col(c))
    lo, hi = real("a"), real("b")
    mid = F.when(lo == hi, lo).otherwise((first + 1 - pos) * lo + (pos - first) * hi)
    return ends.withColumn("m", mid).groupBy(*[F.col(a).alias(k) for k, a in zip(keys, at, strict=True)]).agg(*[
        F.max(F.when(F.col("_f") == i, F.col("m"))).alias(c) for i, c in enumerate(cols)])


def _ends(groups: DataFrame, found: DataFrame, group: list[str], q: float) -> DataFrame:
    """(group, n, a, b): the values at both ranks of the quantile, null where a rank was not found."""
    pos = F.lit(q) * (F.col("n") - 1)
    both = found.groupBy(*[F.col(g).alias(f"_x{g}") for g in group], "n").agg(
        F.max(F.when(F.col("k") == F.floor(pos), F.col("value"))).alias("a"),
        F.max(F.when(F.col("k") == F.ceil(pos), F.col("value"))).alias("b")).drop("n")
    return groups.join(both, [F.col(g).eqNullSafe(F.col(f"_x{g}")) for g in group], "left").select(*group, "n", "a", "b")


def _narrow_by(spark, long: DataFrame, group: list[str], state: DataFrame) -> DataFrame:
    """(group, n, k, value): the value at rank k of each row of ``state(group, n, k, lo, hi, below)``.

    Histogram narrowing over the weighted values ``long(group, v, w)`` with its
    state in a table, written to the shared folder between passes: a group of
    any size is only ever counted, bucket by bucket, never gathered.
    """
    cols = [*group, "n", "k", "lo", "hi", "below"]
    state = state.select(*cols)
    long = long.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while True:
            path = work_dir(spark, "quantile")
            state.write.parquet(path)
            state = spark.read.parquet(path)
            todo = state.where("lo < hi")
            if todo.isEmpty():
                return state.select(*group, "n", "k", F.col("lo").alias("value"))
            cond = [F.col(f"v.{g}").eqNullSafe(F.col(f"t.{g}")) for g in group]
            cell = long.alias("v").join(todo.alias("t"), cond).where("v.v between t.lo and t.hi")
            hist = cell.groupBy(*[F.col(f"t.{c}").alias(c) for c in (*group, "n", "k", "below")],
                                _bucket(F.col("v.v"), F.col("t.lo"), F.col("t.hi")).alias("b")) \
                .agg(F.sum("v.w").alias("m"), F.min("v.v").alias("lo"), F.max("v.v").alias("hi"))
            run = Window.partitionBy(*group, "k").orderBy("b")
            hist = hist.withColumn("below", F.col("below") + F.sum("m").over(run) - F.col("m"))
            state = state.where("lo = hi").unionByName(hist.where("below <= k and k < below + m").select(*cols))
    finally:
        long.unpersist()
