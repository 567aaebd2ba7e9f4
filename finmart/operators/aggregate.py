"""Grouped and whole-table statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.functions.numbers import nan_to_null, whole_number
from finmart.operators.columns import numeric_columns, quoted
from finmart.operators.joins import lookup
from finmart.operators.ordering import for_percentile, quantiles
from finmart.session import IN_TASK_ROWS, written

QUARTILES = [0.25, 0.5, 0.75]
QUARTILE_NAMES = ["q1", "mediana", "q3"]
# Texts up to this length are grouped as they are, longer ones by a digest.
KEY_BYTES = 40


def group_sums(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(quoted(m)).alias(f"soma_{m}") for m in measures))


def pivot_sum(df: DataFrame, keys: list[str], spread: str, measure: str, values: list[str],
              rest: tuple[str, str] | None = None) -> DataFrame:
    """Spread a column's declared values into columns, summing the whole-number part of the measure.

    One conditional sum per value: a single shuffle, on the keys alone, of partly summed rows. ``pivot`` would shuffle
    twice, first on the keys and the spread column. ``rest`` names two more columns, the sum and the number of the rows
    whose value is not declared (NULL included), so that every row of the input is in some column.
    """
    # once per row, below the aggregate
    lean = df.select(*(quoted(k) for k in keys), quoted(spread).alias("_spread"), whole_number(quoted(measure)).alias("_whole"))
    sums = [F.sum(F.when(F.col("_spread") == v, F.col("_whole"))).alias(v) for v in values]
    if rest:
        other = ~F.coalesce(F.col("_spread").isin(values), F.lit(False))
        sums += [F.sum(F.when(other, F.col("_whole"))).alias(rest[0]), F.count_if(other).alias(rest[1])]
    return lean.groupBy(*keys).agg(*sums)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequencies, most frequent first; NULL is not a value."""
    counts = df.where(quoted(column).isNotNull()).groupBy(quoted(column)).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), quoted(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct().orderBy(quoted(column))


def group_sum_desc(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """Sum per key, largest first; a key with only NULLs sums to 0; the NULL key is dropped."""
    sums = df.where(quoted(key).isNotNull()).groupBy(key).agg(F.coalesce(F.sum(quoted(measure)), F.lit(0.0)).alias(name))
    return sums.orderBy(F.desc(name), key)


def _moments(column: str) -> list[Column]:
    return [F.count(column).alias("n"), F.avg(column).alias("media"), F.stddev(column).alias("desvio"),
            F.min(column).alias("minimo"), F.max(column).alias("maximo")]


def describe(df: DataFrame, measure: str, keys: list[str], in_task: int = IN_TASK_ROWS) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per key (NULL keys dropped).

    One aggregate while the exact quartiles may be built in tasks; beyond that they come from :func:`quantiles`.
    """
    present = _tidy(df.select(*(quoted(k) for k in keys), quoted(measure).alias("_m")))
    for k in keys:
        present = present.where(quoted(k).isNotNull())
    ready = for_percentile(present, keys, in_task)
    if ready is not None:
        packed = ready.groupBy(*keys).agg(*_moments("_m"), F.percentile("_m", QUARTILES).alias("_q"))
        return packed.withColumns({n: F.col("_q")[i] for i, n in enumerate(QUARTILE_NAMES)}).drop("_q")
    # both sides hold one row per key
    points = quantiles(present, "_m", QUARTILES, keys, QUARTILE_NAMES, in_task)
    return present.groupBy(*keys).agg(*_moments("_m")).join(points, keys, "left")


def _tidy(rows: DataFrame) -> DataFrame:
    """The measure column ``_m`` with NaN as NULL; the keys stay as they are."""
    kind = rows.schema["_m"].dataType.typeName()
    return rows.withColumn("_m", F.when(~F.isnan("_m"), F.col("_m"))) if kind in ("double", "float") else rows


def mean_median(df: DataFrame, key: str, measure: str, in_task: int = IN_TASK_ROWS) -> DataFrame:
    return describe(df, measure, [key], in_task).select(key, "media", "mediana")


def transpose(df: DataFrame, key: str, statistics: list[str], key_values: list[str]) -> DataFrame:
    """One row per statistic, one column per declared key value."""
    long = df.unpivot([quoted(key)], [quoted(s) for s in statistics], "estatistica", "valor")
    return long.groupBy("estatistica").pivot(key, key_values).agg(F.max("valor"))


def numbers_to_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """(coluna, valor) rows of the numeric columns, as double."""
    wide = df.select(*(quoted(c).cast("double").alias(c) for c in columns))
    return wide.unpivot([], [quoted(c) for c in columns], "coluna", "valor")


def texts_to_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """(coluna, valor) rows of any columns, as text."""
    tidy = nan_to_null(df.select(*(quoted(c) for c in columns)))
    wide = tidy.select(*(quoted(c).cast("string").alias(c) for c in columns))
    return wide.unpivot([], [quoted(c) for c in columns], "coluna", "valor")


def describe_numeric(df: DataFrame, columns: list[str] | None = None, **options) -> DataFrame:
    """:func:`describe` of every numeric column, one row per column; the columns are described side by side."""
    return describe(numbers_to_rows(df, columns or numeric_columns(df)), "valor", ["coluna"], **options)


def describe_columns(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, minimum and maximum of every column, texts included, one row per column.

    Minimum and maximum are text (numbers by value, not by spelling); one pass over the data.
    """
    df = nan_to_null(df)
    numeric = set(numeric_columns(df))
    aggs = []
    for c in df.columns:
        is_number = c in numeric
        aggs.append(F.struct(
            F.lit(c).alias("coluna"), F.count(quoted(c)).alias("n"),
            (F.avg(quoted(c)) if is_number else F.lit(None)).cast("double").alias("media"),
            (F.stddev(quoted(c)) if is_number else F.lit(None)).cast("double").alias("desvio"),
            F.min(quoted(c)).cast("string").alias("minimo"), F.max(quoted(c)).cast("string").alias("maximo")))
    return df.agg(F.array(*aggs).alias("_all")).selectExpr("inline(_all)")


def top_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: distinct values, the most frequent value (the smaller on a tie) and its frequency.

    Short values are counted as they are. Where a text column holds values longer than ``KEY_BYTES``, those are counted by
    their digest, so a column of long texts, near-unique ones too, moves 64 bytes a value and never a whole text; the
    texts behind the digests that may win are looked at in a second pass over that column.
    """
    kinds = dict(df.dtypes)
    texts = [c for c in columns if kinds[c] == "string"]
    widest = df.agg(*(F.max(F.octet_length(quoted(c))).alias(str(i)) for i, c in enumerate(texts))).first() if texts else ()
    long = [c for c, most in zip(texts, widest) if most is not None and most > KEY_BYTES]
    short = [c for c in columns if c not in long]
    parts = [_top_short(df, short)] if short else []
    parts += [_top_long(df, c) for c in long]
    return reduce(DataFrame.unionByName, parts)


def text_key(value: Column) -> Column:
    """A text, or its digest where it is long: a digest has 64 letters, more than any text that is its own key."""
    return F.when(F.octet_length(value) > KEY_BYTES, F.sha2(value, 256)).otherwise(value)


def _top_short(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = texts_to_rows(df, columns).where(F.col("valor").isNotNull()).groupBy("coluna", "valor").agg(
        F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("coluna").agg(
        F.count(F.lit(1)).alias("distintos"), F.min_by("valor", F.struct(-F.col("_n"), F.col("valor"))).alias("moda"),
        F.max("_n").alias("frequencia"))


def _top_long(df: DataFrame, column: str) -> DataFrame:
    """The row of a text column with long values."""
    rows = df.select(quoted(column).alias("valor"), text_key(quoted(column)).alias("_key")).where("valor IS NOT NULL")
    counts = written(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")), "digests")
    distinct, most = counts.agg(F.count(F.lit(1)), F.max("_n")).first()
    # where nothing repeats every value wins, else the values of the winning keys
    winners = rows if most == 1 else lookup(rows, counts.where(F.col("_n") == most).select("_key"), ["_key"], "left_semi")
    return winners.agg(F.min("valor").alias("moda")).select(
        F.lit(column).alias("coluna"), F.lit(distinct).cast("long").alias("distintos"), "moda",
        F.lit(most).cast("long").alias("frequencia"))


def describe_all(df: DataFrame, **options) -> DataFrame:
    """Every column: count, distinct, most frequent and, for numbers, the :func:`describe` statistics."""
    df = nan_to_null(df)
    counts = df.agg(F.array(*(F.struct(F.lit(c).alias("coluna"), F.count(quoted(c)).alias("n")) for c in df.columns))
                    .alias("_all")).selectExpr("inline(_all)")
    # every side holds one row per column
    return counts.join(top_values(df, df.columns), "coluna", "left").join(
        describe_numeric(df, **options).drop("n"), "coluna", "left")


def describe_boxes(df: DataFrame, measure: str, keys: list[str], whisker: float = 1.5, **options) -> DataFrame:
    """:func:`describe` per key, with the whisker ends and how many rows lie beyond the fences (``fora``)."""
    stats = _with_fences(describe(df, measure, keys, **options), whisker)
    rows = _tidy(df.select(*(quoted(k) for k in keys), quoted(measure).alias("_m"))).where("_m IS NOT NULL")
    fences = stats.select(*keys, "cerca_inf", "cerca_sup")
    inside = F.col("_m").between(F.col("cerca_inf"), F.col("cerca_sup"))
    ends = lookup(rows, fences, keys, "inner").groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_m"))).alias("bigode_inf"), F.max(F.when(inside, F.col("_m"))).alias("bigode_sup"),
        F.count_if(~inside).alias("fora"))
    # both sides hold one row per key
    return stats.drop("cerca_inf", "cerca_sup").join(ends, keys, "left")


def box_stats(df: DataFrame, measure: str, keys: list[str], whisker: float = 1.5, **options) -> DataFrame:
    """Box-plot numbers per key, or of the whole table without keys."""
    wanted = ["n", *QUARTILE_NAMES, "bigode_inf", "bigode_sup", "fora"]
    group = keys or ["_all"]
    return describe_boxes(df.withColumn("_all", F.lit(0)), measure, group, whisker, **options).select(*keys, *wanted)


def box_outliers(df: DataFrame, measure: str, keys: list[str], whisker: float = 1.5, **options) -> DataFrame:
    """The rows beyond the fences, with all their columns."""
    # NaN is missing here too, and sorts after every number
    rows = df.where(quoted(measure).cast("double") <= float("inf")).withColumn("_all", F.lit(0))
    group = keys or ["_all"]
    points = quantiles(rows, measure, QUARTILES, group, QUARTILE_NAMES, **options)
    fences = _with_fences(points, whisker).select(*group, "cerca_inf", "cerca_sup")
    beyond = ~quoted(measure).between(F.col("cerca_inf"), F.col("cerca_sup"))
    return lookup(rows, fences, group, "inner").where(beyond).select(*(quoted(c) for c in df.columns))


def _with_fences(points: DataFrame, whisker: float) -> DataFrame:
    """Stored, because the quartiles are needed twice: to measure the table and to join it."""
    reach = whisker * (F.col("q3") - F.col("q1"))
    return written(points.withColumns({"cerca_inf": F.col("q1") - reach, "cerca_sup": F.col("q3") + reach}), "fences")


def whole_sum(df: DataFrame, measure: str, name: str) -> DataFrame:
    return df.agg(F.sum(whole_number(quoted(measure))).alias(name))


def totals(df: DataFrame, **aggregates: Column) -> DataFrame:
    return df.agg(*(a.alias(n) for n, a in aggregates.items()))
