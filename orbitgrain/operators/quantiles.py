"""Exact quantiles of large groups, without bringing a group's values together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], accuracy: int = 10_000) -> DataFrame:
    """(keys, q): the quantiles of ``value`` at ``shares`` as an array, interpolated between neighbours; nulls do not count.

    A sketch of each group, combined before its shuffle, brackets every wanted
    rank between two values with about 10 / ``accuracy`` of the group's rows in
    between, however the values are spread; a group of at most ``accuracy`` rows
    is one bracket. Rows below a bracket are counted,
    those inside by value; a window runs over a bracket's different values.
    That the bracket holds the rank is checked, so a result is exact or an
    error. ``rows`` is read three times: set it down first if it is costly.
    Keys may be null and have any name; a group without values has no row;
    values are no NaN.
    """
    named = {k: f"_key{i}" for i, k in enumerate(keys)}
    own = list(named.values())
    some = rows.select(*(F.col(f"`{k}`").alias(n) for k, n in named.items()), F.col(f"`{value}`").cast("double").alias("_v")).filter("_v is not null")
    margin, top = 5.0 / accuracy, float("inf")
    ends = [(max(0.0, s - margin), min(1.0, s + margin)) for s in shares]
    sketch = some.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", [p for pair in ends for p in pair], accuracy).alias("_cut"))
    small = F.col("_n") <= accuracy  # a group of so few values is a bracket by itself
    bracket = F.array(
        *(
            F.struct(
                F.lit(i).alias("i"), (F.lit(float(s)) * (F.col("_n") - 1)).alias("at"),
                F.when(small | F.lit(low == 0), -top).otherwise(F.get("_cut", F.lit(2 * i))).alias("low"), F.when(small | F.lit(high == 1), top).otherwise(F.get("_cut", F.lit(2 * i + 1))).alias("high"),
            )
            for i, (s, (low, high)) in enumerate(zip(shares, ends, strict=True))
        )
    )
    groups = sketch.select(*(F.col(n).alias(f"_g{n}") for n in own), bracket.alias("_b"))
    same = F.lit(True)
    for n in own:
        same = same & F.col(n).eqNullSafe(F.col(f"_g{n}"))
    met = some.join(groups, same) if own else some.crossJoin(F.broadcast(groups))  # one row: the whole table is the group
    below = met.groupBy(*own).agg(F.array(*(F.count_if(F.col("_v") < F.col("_b")[i]["low"]) for i in range(len(shares)))).alias("_below"), F.first("_b").alias("_b"))
    wanted = below.select(*own, F.explode(F.zip_with("_b", "_below", lambda b, n: F.struct(b["i"].alias("i"), b["at"].alias("at"), n.alias("below")))).alias("_w")).select(*own, "_w.*")
    within = F.filter("_b", lambda b: (F.col("_v") >= b["low"]) & (F.col("_v") <= b["high"]))
    inside = met.select(*own, "_v", F.explode(F.transform(within, lambda b: b["i"])).alias("i")).groupBy(*own, "i", "_v").agg(F.count(F.lit(1)).alias("_m"))
    up = Window.partitionBy(*own, "i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = inside.withColumn("_through", F.sum("_m").over(up))
    w = wanted.withColumnsRenamed({n: f"_w{n}" for n in own} | {"i": "_i"})
    hit = F.col("i") == F.col("_i")
    for n in own:
        hit = hit & F.col(n).eqNullSafe(F.col(f"_w{n}"))
    both = placed.join(w, hit)
    first = F.col("below") + F.col("_through") - F.col("_m")  # the rank of the value's first row
    last = F.col("below") + F.col("_through") - 1
    holds = lambda rank: F.col("_v") * F.when((rank >= first) & (rank <= last), 1.0)
    each = both.groupBy(*own, "i").agg(F.max(holds(F.floor("at"))).alias("_lo"), F.max(holds(F.ceil("at"))).alias("_hi"), F.first("at").alias("at"))
    part = F.col("at") - F.floor("at")
    sure = F.when(F.col("_lo").isNotNull() & F.col("_hi").isNotNull(), F.col("_lo") * (1 - part) + F.col("_hi") * part).otherwise(F.raise_error("a sketch missed a rank").cast("double"))
    found = each.select(*own, "i", sure.alias("q")).groupBy(*own).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "q"))), lambda s: s["q"]).alias("q"))
    return found.select(*(F.col(n).alias(k) for k, n in named.items()), "q")
