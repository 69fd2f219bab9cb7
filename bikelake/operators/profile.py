"""Profiling operators.

Each profile is one or two aggregate passes over the data; nothing is pulled
to the driver except the (bounded) one-row results the caller asks for.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikelake.functions.clean import round_decimal


def profile_nulls(df: DataFrame) -> DataFrame:
    """Per-column NULL counts in ONE pass, long format:
    ``column_name, data_type, row_count, null_count``."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + \
        [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    stacked = one.select(
        "__rows",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                     F.lit(t).alias("data_type"), F.col(f"n{i}").alias("null_count"))
            for i, (c, t) in enumerate(df.dtypes)])).alias("s"))
    return stacked.select(F.col("s.ordinal").alias("ordinal"), "s.column_name", "s.data_type",
                          F.col("__rows").alias("row_count"), "s.null_count")


def profile_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct key combinations (NULLs count as a value, like pandas),
    duplicate rows (= rows - distinct) and rows with a NULL key part."""
    keys = list(keys)
    k = F.struct(*[F.col(c) for c in keys])
    any_null = None
    for c in keys:
        t = F.col(c).isNull()
        any_null = t if any_null is None else any_null | t
    out = df.agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_distinct(k).alias("distinct_keys"),
                 F.count_if(any_null).alias("null_key_rows"))
    return out.select("row_count", "distinct_keys",
                      (F.col("row_count") - F.col("distinct_keys")).alias("duplicate_rows"),
                      "null_key_rows", F.lit(len(df.columns)).cast("long").alias("column_count"))


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row, one ``count_if`` per named predicate."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def sample_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows by an explicit order (top-k: ``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(n)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  measures: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Keys present in both snapshots whose measures changed.

    Output: keys, ``<m>_old``, ``<m>_new`` for every measure.  ``null_safe``
    counts NULL -> value as a change and NULL -> NULL as none (trap T7);
    otherwise SQL ``<>`` semantics (any NULL -> not changed).
    """
    keys = list(keys)
    o = old.select(*keys, *[F.col(m).alias(f"{m}_old") for m in measures])
    n = new.select(*keys, *[F.col(m).alias(f"{m}_new") for m in measures])
    j = o.join(n, keys, "inner")
    changed = None
    for m in measures:
        a, b = F.col(f"{m}_old"), F.col(f"{m}_new")
        c = ~a.eqNullSafe(b) if null_safe else (a != b)
        changed = c if changed is None else changed | c
    cols = list(keys)
    for m in measures:
        cols += [f"{m}_old", f"{m}_new"]
    return j.filter(changed).select(*cols)


_QUANTILES = (0.25, 0.5, 0.75)


def _number(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)  # NaN is a missing value


def _narrowed(df: DataFrame, wanted: list[tuple], max_bracket: int, accuracy: int) -> list[dict]:
    """A bracket of values around the ranks of every wanted ``(column, low rank, high rank, n)``.

    Each round takes approximate quantiles a little below and above the ranks, within the
    bracket so far, for all columns in one pass, then counts what lies below and within the new
    brackets in another.  A bracket is done when it holds ``max_bracket`` rows or one value.
    """
    found = [{"c": c, "lo": lo, "hi": hi, "low": None, "high": None, "below": 0, "rows": n, "open": n > 0}
             for c, lo, hi, n in wanted]

    def inside(b: dict) -> Column:
        v = _number(b["c"])
        return v.isNotNull() if b["low"] is None else v.between(b["low"], b["high"])

    while any(b["open"] for b in found):
        work = [b for b in found if b["open"]]
        aims = []
        for k, b in enumerate(work):
            margin = 2.0 / accuracy
            f = [max(0.0, (b["lo"] - b["below"]) / b["rows"] - margin), min(1.0, (b["hi"] - b["below"] + 1) / b["rows"] + margin)]
            aims.append(F.percentile_approx(F.when(inside(b), _number(b["c"])), f, accuracy).alias(f"p{k}"))
        bounds = df.agg(*aims).first()
        news = [{**b, "low": bounds[k][0], "high": bounds[k][1]} for k, b in enumerate(work)]
        counts = df.agg(*[e for k, b in enumerate(news) for e in (
            F.count_if(_number(b["c"]) < b["low"]).alias(f"b{k}"), F.count_if(inside(b)).alias(f"i{k}"))]).first()
        for k, (b, new) in enumerate(zip(work, news)):
            below, rows = counts[f"b{k}"], counts[f"i{k}"]
            holds = below <= b["lo"] and b["hi"] < below + rows
            smaller = holds and (b["low"] is None or rows < b["rows"])
            if holds:
                b.update(low=new["low"], high=new["high"], below=below, rows=rows)
            b["open"] = smaller and rows > max_bracket and b["low"] < b["high"]
    return found


def _exact_quantiles(df: DataFrame, counts: dict[str, int], qs=_QUANTILES, max_bracket: int = 1_000_000,
                     accuracy: int = 10_000) -> dict[tuple[str, float], float]:
    """Linear-interpolated quantiles (pandas / ``percentile``) of several columns.

    Narrow brackets around the needed ranks first; only their rows are grouped by value and
    ordered, so no column is sorted and a value that a third of the rows hold is one row.
    """
    place = {(c, q): q * (n - 1) for c, n in counts.items() if n for q in qs}
    found = _narrowed(df, [(c, math.floor(p), math.ceil(p), counts[c]) for (c, _), p in place.items()], max_bracket, accuracy)
    if not found:
        return {}
    cells = F.array(*[F.when(_number(b["c"]).isNotNull() if b["low"] is None else _number(b["c"]).between(b["low"], b["high"]),
                             F.struct(F.lit(k).alias("k"), _number(b["c"]).alias("v"))) for k, b in enumerate(found)])
    values = (df.select(F.inline(F.filter(cells, lambda x: x.isNotNull()))).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("v"))))
    ranks = F.create_map(*[F.lit(x) for k, b in enumerate(found) for x in (k, [b["lo"] - b["below"], b["hi"] - b["below"]])])

    def at(i: int) -> Column:
        rank = ranks[F.col("k")][i]
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("v")))

    picked = {r.k: r for r in values.groupBy("k").agg(at(0).alias("lo"), at(1).alias("hi")).collect()}
    return {key: picked[k].lo + (picked[k].hi - picked[k].lo) * (p - math.floor(p)) if picked[k].hi != picked[k].lo
            else picked[k].lo for k, (key, p) in enumerate(place.items())}


def profile_describe(df: DataFrame, cols: Sequence[str], exact: bool = True,
                     accuracy: int = 100_000, max_bracket: int = 1_000_000) -> DataFrame:
    """``describe()`` per numeric column: count, mean, std, min, 25/50/75 %, max.

    All columns share every pass.  ``exact=True`` finds the interpolated quantiles by bracket
    selection; ``exact=False`` uses ``percentile_approx`` (one pass, bounded memory).
    Values are rounded to 6 decimals.  One row per column; the driver holds no other.
    """
    cols = list(cols)
    one = df.agg(*[e.alias(f"{x}{k}") for k, c in enumerate(cols) for x, e in (
        ("count", F.count(_number(c))), ("mean", F.avg(_number(c))), ("std", F.stddev_samp(_number(c))),
        ("min", F.min(_number(c))), ("max", F.max(_number(c))),
        *([] if exact else [("q", F.percentile_approx(_number(c), list(_QUANTILES), accuracy))]))]).first()
    found = _exact_quantiles(df, {c: one[f"count{k}"] for k, c in enumerate(cols)}, max_bracket=max_bracket) if exact else {
        (c, q): one[f"q{k}"][i] for k, c in enumerate(cols) if one[f"count{k}"] for i, q in enumerate(_QUANTILES)}
    rows = [(c, one[f"count{k}"], one[f"mean{k}"], one[f"std{k}"], one[f"min{k}"], *[found.get((c, q)) for q in _QUANTILES], one[f"max{k}"])
            for k, c in enumerate(cols)]
    names = ["mean", "std", "min", *[f"p{int(q * 100)}" for q in _QUANTILES], "max"]
    table = df.sparkSession.createDataFrame(rows, "column_name string, count long, " + ", ".join(f"{x} double" for x in names))
    return table.select("column_name", "count", *[round_decimal(F.col(x), 6).alias(x) for x in names])


def profile_report(df: DataFrame, n: int = 5, order: Sequence[Column] | None = None) -> dict:
    """Snapshot profile (R1): shape, columns, dtypes, null counts, sample rows.

    Returns small, bounded objects: the null profile and the sample stay DataFrames.
    """
    return {
        "rows": df.count(),
        "columns": list(df.columns),
        "dtypes": dict(df.dtypes),
        "nulls": profile_nulls(df),
        "sample": sample_rows(df, order or [F.col(df.columns[0])], n),
    }
