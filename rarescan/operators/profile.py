"""Data profile: quality, domains, distributions, risk per category.

Each table comes from one or two scans that cover all columns at once; only
per-feature rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.functions.columns import long_form, ratio0, unpivot_structs
from rarescan.operators.quantiles import exact_quantiles

OUTLIER_FENCE = 1.5
LISTED_VALUES = 30
TOP_VALUES = 5
HISTOGRAM_BINS = 30


def _stacked(row_per_feature: DataFrame, fields: Sequence[tuple[str, str]], features) -> DataFrame:
    """Turn one wide aggregate row with ``<name>__<feature>`` columns into rows."""
    entry = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                *[F.col(f"{name}__{f}").cast(kind).alias(name) for name, kind in fields],
            )
            for f in features
        ]
    )
    keep = [c for c in row_per_feature.columns if "__" not in c]
    return row_per_feature.select(*keep, F.explode(entry).alias("e")).select(*keep, "e.*")


def small_table(spark, rows: list, schema: str) -> DataFrame:
    """Per-feature facts (a few rows) as a DataFrame."""
    return spark.createDataFrame(rows, schema)


# ---- type narrowing -----------------------------------------------------------

# Ranges of the integer types, smallest first.
INTEGER_RANGES = (
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _narrow_type(name: str, narrow_floats: bool, integer: bool) -> Column:
    if not integer:
        return F.lit("float" if narrow_floats else "double")
    low, high = F.col(f"min_value__{name}"), F.col(f"max_value__{name}")
    chosen = F.lit("bigint")
    for kind, smallest, largest in reversed(INTEGER_RANGES):
        fits = (low > smallest) & (high < largest)  # strict on both sides
        chosen = F.when(fits, kind).otherwise(chosen)
    return chosen


def type_plan(train: DataFrame, columns: Sequence[str], narrow_floats: bool = False) -> DataFrame:
    """Per numeric column: observed range and the smallest type that holds it."""
    integer = {f.name: isinstance(f.dataType, _INTEGERS) for f in train.schema}
    wide = train.agg(
        *[F.min(c).alias(f"min_value__{c}") for c in columns],
        *[F.max(c).alias(f"max_value__{c}") for c in columns],
    ).withColumns(
        {f"chosen_type__{c}": _narrow_type(c, narrow_floats, integer[c]) for c in columns}
    )
    fields = [("min_value", "double"), ("max_value", "double"), ("chosen_type", "string")]
    return _stacked(wide, fields, columns)


def narrow_types(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Apply a plan decided on the train split (so all splits share one schema)."""
    chosen = {r["feature"]: r["chosen_type"] for r in plan.collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in chosen.items() if c in df.columns})


# ---- structure and quality ----------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column type, non-null count, null count and share; worst first."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    wide = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count(c).alias(f"non_null__{c}") for c in columns],
    ).withColumns({f"dtype__{c}": F.lit(kinds[c]) for c in columns})
    rows = _stacked(wide, [("dtype", "string"), ("non_null", "bigint")], columns)
    nulls = F.col("n_rows") - F.col("non_null")
    return rows.select(
        "feature",
        "dtype",
        "non_null",
        nulls.alias("null_count"),
        (ratio0(nulls, F.col("n_rows")) * 100).alias("null_pct"),
    ).orderBy(F.desc("null_pct"), "feature")


def typed_values(df: DataFrame, columns: Sequence[str], keep: Sequence = ()) -> DataFrame:
    """Long form (feature, as_long, as_double, as_string): values compared exactly."""
    kinds = {f.name: f.dataType for f in df.schema}

    def cell(c: str) -> list[Column]:
        kind, value = kinds[c], F.col(c)
        whole, real = isinstance(kind, _INTEGERS), isinstance(kind, (T.DoubleType, T.FloatType))
        return [
            (value.cast("bigint") if whole else F.lit(None).cast("bigint")).alias("as_long"),
            (value.cast("double") + F.lit(0.0) if real else F.lit(None).cast("double")).alias(
                "as_double"
            ),
            (F.lit(None).cast("string") if whole or real else value.cast("string")).alias(
                "as_string"
            ),
        ]

    kept = df.select(*keep, unpivot_structs(columns, cell).alias("e"))
    return kept.select(*kept.columns[:-1], "e.*")


def _present() -> Column:
    """1 for a value, null for a null cell of ``typed_values``."""
    some = F.col("as_long").isNotNull() | F.col("as_double").isNotNull()
    return F.when(some | F.col("as_string").isNotNull(), 1)


def cardinality(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column, in one job for all columns."""
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(f"n_distinct__{c}") for c in columns])
        return _stacked(wide, [("n_distinct", "bigint")], columns)
    long = typed_values(df, columns).distinct()
    return long.groupBy("feature").agg(F.count(_present()).alias("n_distinct"))


def quality_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, nulls and cardinality of every column; most nulls first."""
    return (
        null_counts(df, columns)
        .join(cardinality(df, columns), "feature")
        .orderBy(F.desc("null_pct"), "feature")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows (nulls equal).

    Rows are first counted by a 128-bit hash of all columns, so only two numbers and
    a count per distinct row are shuffled, copies combined before; whether an
    equal hash is an equal row is then checked on the rows of those hashes alone.
    """
    hashed = df.select(F.struct(*df.columns).alias("row")).select(
        "row",
        F.xxhash64("row").alias("h1"),
        F.xxhash64(F.lit(1), "row").alias("h2"),
    )
    seen = hashed.groupBy("h1", "h2").agg(F.count("*").alias("copies"))
    more = seen.where("copies > 1").select("h1", "h2")
    groups = (
        hashed.join(more, ["h1", "h2"], "left_semi")
        .groupBy("row")
        .agg(F.count("*").alias("copies"))
    )
    nothing = F.lit(0).cast("bigint")
    rows = seen.agg(F.sum("copies").alias("n_rows"), nothing.alias("n_duplicates"))
    extra = groups.agg(nothing.alias("n_rows"), F.sum(F.col("copies") - 1).alias("n_duplicates"))
    both = rows.unionByName(extra).agg(*(F.sum(c).alias(c) for c in ("n_rows", "n_duplicates")))
    return both.select(
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_duplicates", F.lit(0)).alias("n_duplicates"),
        (ratio0(F.col("n_duplicates"), F.col("n_rows")) * 100).alias("duplicate_pct"),
    )


# ---- numeric distributions ------------------------------------------------------


QUARTILES = (0.25, 0.5, 0.75)


def describe_numeric(
    df: DataFrame, columns: Sequence[str], quartiles: dict | None = None, **quantile_args
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column.

    ``quartiles`` saves a pass where they are known already.
    """
    quartiles = quartiles or exact_quantiles(df, columns, QUARTILES, **quantile_args)
    return (
        long_form(df, {c: F.col(c).cast("double") for c in columns})
        .groupBy("feature")
        .agg(*_moments(F.col("value")))
        .withColumn("q", _lookup(F.col("feature"), quartiles, "array<double>"))
        .select("feature", "n", *_moment_columns())
    )


def _moments(value: Column) -> list[Column]:
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def _moment_columns() -> list[Column]:
    quartiles = [F.get("q", i).alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    order = [F.col("mean"), F.col("std"), F.col("min"), *quartiles, F.col("max")]
    names = ("mean", "std", "min", "p25", "p50", "p75", "max")
    return [c.alias(n) for c, n in zip(order, names)]


def _lookup(key: Column, facts: dict, kind: str) -> Column:
    """Per-feature facts as a literal map (at most one entry per feature and class)."""
    entries = []
    for k, v in facts.items():
        values = [F.lit(x).cast("double") for x in v]
        entries += [F.lit(k), F.array(*values).cast(kind)]
    return F.try_element_at(F.create_map(*entries), key)


def outlier_bounds(
    df: DataFrame, columns: Sequence[str], quartiles: dict | None = None, **quantile_args
) -> dict:
    """Fences Q1 - 1.5 IQR and Q3 + 1.5 IQR per column."""
    quartiles = quartiles or exact_quantiles(df, columns, QUARTILES, **quantile_args)
    out = {}
    for c, (q1, _, q3) in quartiles.items():
        if q1 is not None:
            iqr = q3 - q1
            out[c] = (q1 - OUTLIER_FENCE * iqr, q3 + OUTLIER_FENCE * iqr)
    return out


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], quartiles: dict | None = None, **quantile_args
) -> DataFrame:
    """Rows strictly outside the fences per column; share of all rows, worst first."""
    bounds = outlier_bounds(df, columns, quartiles, **quantile_args)
    aggregates = [F.count("*").alias("n_rows")]
    for c, (low, high) in bounds.items():
        outside = (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))
        aggregates += [
            F.count(F.when(outside, 1)).alias(f"outliers__{c}"),
            F.lit(low).alias(f"lower_bound__{c}"),
            F.lit(high).alias(f"upper_bound__{c}"),
        ]
    fields = [("outliers", "bigint"), ("lower_bound", "double"), ("upper_bound", "double")]
    return (
        _stacked(df.agg(*aggregates), fields, list(bounds))
        .select(
            "feature",
            "outliers",
            (ratio0(F.col("outliers"), F.col("n_rows")) * 100).alias("outlier_pct"),
            F.col("lower_bound").alias("lower_bound"),
            F.col("upper_bound").alias("upper_bound"),
        )
        .orderBy(F.desc("outlier_pct"), "feature")
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram per column; the last bin is closed.

    A constant column gets the range value - 0.5 .. value + 0.5.
    """
    ranges = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo__{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"hi__{c}") for c in columns],
    ).first()
    limits = {}
    for c in columns:
        lo, hi = ranges[f"lo__{c}"], ranges[f"hi__{c}"]
        if lo is not None:
            limits[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)

    bin_of = {}
    for c, (lo, hi) in limits.items():
        at = F.floor((F.col(c).cast("double") - lo) / (hi - lo) * bins)
        bin_of[c] = F.least(at, F.lit(bins - 1)).cast("int")
    counted = (
        long_form(df, bin_of)
        .where("value IS NOT NULL")
        .groupBy("feature", F.col("value").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edges = F.lit(None).cast("struct<lo:double,hi:double>")
    for c, (lo, hi) in limits.items():
        edges = F.when(
            F.col("feature") == c, F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
        ).otherwise(edges)
    step = (F.col("r.hi") - F.col("r.lo")) / bins
    return counted.withColumn("r", edges).select(
        "feature",
        "bin",
        (F.col("r.lo") + step * F.col("bin")).alias("bin_start"),
        "n",
    )


def box_stats(
    df: DataFrame, columns: Sequence[str], label: str, classes=(0, 1), **quantile_args
) -> DataFrame:
    """Box-plot numbers per class for every column.

    Whiskers are the extreme values inside the fences.
    """
    slots = {
        (c, k): F.when(F.col(label) == F.lit(k), F.col(c).cast("double"))
        for c in columns
        for k in classes
    }
    quartiles = exact_quantiles(df, list(slots.items()), QUARTILES, **quantile_args)
    aggregates, known = [], []
    for (c, k), value in slots.items():
        q1, q2, q3 = quartiles[c, k]
        if q1 is None:
            continue
        low, high = q1 - OUTLIER_FENCE * (q3 - q1), q3 + OUTLIER_FENCE * (q3 - q1)
        inside = value.between(low, high)
        i = len(known)
        known.append((c, k, q1, q2, q3))
        aggregates += [
            F.min(F.when(inside, value)).alias(f"lo{i}"),
            F.max(F.when(inside, value)).alias(f"hi{i}"),
            F.count(F.when(~inside, 1)).alias(f"out{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(k).cast("int").alias("class"),
            *[F.lit(q).alias(name) for name, q in zip(("q1", "median", "q3"), qs)],
            F.col(f"lo{i}").alias("whisker_low"),
            F.col(f"hi{i}").alias("whisker_high"),
            F.col(f"out{i}").alias("outliers"),
        )
        for i, (c, k, *qs) in enumerate(known)
    ]
    return df.agg(*aggregates).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# ---- categories and the target -----------------------------------------------------


def category_counts(df: DataFrame, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """(feature, value, n, pos) for all categorical columns in one job."""
    positive = (F.col(label) == 1).cast("bigint") if label else F.lit(0).cast("bigint")
    cells = {c: F.col(c).cast("string") for c in columns}
    return (
        long_form(df, cells, [positive.alias("is_pos")])
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"), F.sum("is_pos").alias("pos"))
    )


def category_domain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All values of a column with up to 30 of them, else the 5 most frequent.

    ``domain`` is an array; null counts as a value and stays null.  Ties in
    frequency go by value.  The row_number
    filter keeps at most 30 rows per feature before any shuffle by feature.
    """
    counts = category_counts(df, columns)
    sizes = counts.groupBy("feature").agg(F.count("*").alias("n_values"))
    by_size = Window.partitionBy("feature").orderBy(F.desc("n"), F.col("value").asc_nulls_last())
    first = (
        counts.withColumn("place", F.row_number().over(by_size))
        .where(F.col("place") <= LISTED_VALUES)
        .join(sizes, "feature")
        .where((F.col("n_values") <= LISTED_VALUES) | (F.col("place") <= TOP_VALUES))
    )
    listed = F.sort_array(F.collect_list(F.struct("place", F.col("value").alias("v"))))
    frequent = F.transform(listed, lambda x: x["v"])
    every = F.sort_array(frequent)  # null first
    return (
        first.groupBy("feature", "n_values")
        .agg(
            F.when(F.col("n_values") <= LISTED_VALUES, every).otherwise(frequent).alias("domain")
        )
        .select("feature", "n_values", "domain")
    )


def target_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(0))  # one row per class
    return counts.select(
        label,
        "n",
        (F.col("n") * 100 / F.sum("n").over(whole)).alias("pct"),
    )


def rate_by_period(df: DataFrame, period: str, label: str) -> DataFrame | None:
    """Positive rate per period; nothing when the table has no such column."""
    if period not in df.columns:
        return None
    return (
        df.where(F.col(period).isNotNull())
        .groupBy(period)
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col(label).cast("bigint")).alias("pos"),
            F.avg(F.col(label).cast("double")).alias("pos_rate"),
        )
        .orderBy(period)
    )


def categorical_risk(
    df: DataFrame, columns: Sequence[str], label: str, max_values: int | None = None
) -> DataFrame:
    """Positive rate per category, riskiest first; the null group is left out.

    ``max_values`` leaves out the columns with more values than that.
    """
    counts = category_counts(df, columns, label).where("value IS NOT NULL")
    if max_values is not None:
        sizes = counts.groupBy("feature").agg(F.count("*").alias("n_values"))
        few = sizes.where(F.col("n_values") <= max_values).select("feature")
        counts = counts.join(few, "feature", "left_semi")
    return (
        counts.select("feature", "value", "n", "pos", (F.col("pos") / F.col("n")).alias("pos_rate"))
        .orderBy("feature", F.desc("pos_rate"), "value")
    )


def class_profile(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    classes=(0, 1),
    **quantile_args,
) -> DataFrame:
    """Every column, overall (class null) and per class, as one long table."""
    groups = [(None, F.lit(True)), *[(k, F.col(label) == F.lit(k)) for k in classes]]
    slots = {
        (c, k): F.when(cond, F.col(c).cast("double")) for c in numeric for k, cond in groups
    }
    quartiles = exact_quantiles(df, list(slots.items()), QUARTILES, **quantile_args)
    # One pass with two grouping sets: by class, and over both classes.
    numbers = set(numeric)
    cells = df.select(
        F.col(label).cast("int").alias("class"),
        unpivot_structs(
            [*numeric, *categorical],
            lambda c: [
                (F.col(c) if c in numbers else F.lit(None)).cast("double").alias("value"),
                F.col(c).isNotNull().alias("present"),
            ],
        ).alias("e"),
    ).select("class", "e.*")
    facts = {f"{c}|{'' if k is None else k}": q for (c, k), q in quartiles.items()}
    slot = F.concat_ws("|", "feature", F.coalesce(F.col("class").cast("string"), F.lit("")))
    stats = (
        cells.groupingSets([["feature", "class"], ["feature"]], "feature", "class")
        .agg(
            *_moments(F.col("value"))[1:],
            F.count(F.when(F.col("present"), 1)).alias("n"),
            F.count(F.when(~F.col("present"), 1)).alias("missing"),
            F.grouping("class").alias("is_overall"),
        )
        .where("is_overall = 1 OR class IS NOT NULL")
        .withColumn("q", _lookup(slot, facts, "array<double>"))
        .select("feature", "class", "n", "missing", *_moment_columns())
    )
    # One pass for all distinct counts: a value knows the classes it occurs in.
    values = (
        typed_values(df, [*numeric, *categorical], keep=[F.col(label).alias("class")])
        .groupBy("feature", "as_long", "as_double", "as_string")
        .agg(*[F.max(F.col("class") == F.lit(k)).alias(f"in_{k}") for k in classes])
        .where(_present().isNotNull())
        .groupBy("feature")
        .agg(
            F.count("*").alias("overall"),
            *[F.count(F.when(F.col(f"in_{k}"), 1)).alias(f"n_{k}") for k in classes],
        )
    )
    sizes = [(None, "overall"), *[(k, f"n_{k}") for k in classes]]
    distinct = values.select(
        "feature",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).cast("int").alias("class"), F.col(n).alias("n_distinct"))
                    for k, n in sizes
                ]
            )
        ).alias("e"),
    ).select("feature", "e.*")
    same = (F.col("s.feature") == F.col("d.feature")) & F.col("s.class").eqNullSafe(
        F.col("d.class")
    )
    # The positive rate of a class is 0 or 1; only the overall one needs counting.
    rate = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return (
        stats.alias("s")
        .join(distinct.alias("d"), same, "left")
        .select(
            "s.*",
            F.coalesce(F.col("s.class").cast("double"), F.lit(rate)).alias("pos_rate"),
            F.coalesce("d.n_distinct", F.lit(0)).alias("n_distinct"),
        )
    )
