"""Column selection, naming and order. Schema-only work unless a column is added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A column whose name may hold dots, newlines or formulae."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by map; names the frame lacks are ignored."""
    return df.withColumnsRenamed(names)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename every column by place; the count must agree."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_at(df: DataFrame, places: dict[int, str]) -> DataFrame:
    """Rename by place, negative places counting from the end."""
    names = df.columns
    for place, name in places.items():
        names[place] = name
    return df.toDF(*names)


def prefix(df: DataFrame, text: str, keep: dict[str, str] | None = None) -> DataFrame:
    """Prefix every column name, but rename the columns of ``keep`` as it says."""
    keep = keep or {}
    return df.toDF(*(keep.get(c, text + c) for c in df.columns))


def insert_after(df: DataFrame, after: str, name: str, value: Column) -> DataFrame:
    """Add a column right after a named one."""
    cols = [quoted(c) for c in df.columns]
    cols.insert(df.columns.index(after) + 1, value.alias(name))
    return df.select(*cols)


def insert_first(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.select(value.alias(name), *(quoted(c) for c in df.columns if c != name))


def drop_first(df: DataFrame) -> DataFrame:
    return df.select(*(quoted(c) for c in df.columns[1:]))


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()})


NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def columns_of_type(df: DataFrame, *kinds: str) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName().split("(")[0] in kinds]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, *NUMERIC)


def select_by_type(df: DataFrame, *kinds: str) -> DataFrame:
    return df.select(*(quoted(c) for c in columns_of_type(df, *kinds)))


def years_to_rows(df: DataFrame, ids: list[str], prefix: str = "ano_", year: str = "ano", value: str = "valor",
                  keep_nulls: bool = False) -> DataFrame:
    """Wide year columns (``ano_2019`` ...) to one row per id and year."""
    wide = [c for c in df.columns if c.startswith(prefix) and c not in ids]
    long = df.unpivot([quoted(c) for c in ids], [quoted(c) for c in wide], year, value)
    long = long.withColumn(year, F.substr(F.col(year), F.lit(len(prefix) + 1)).cast("int"))
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL; a column some frame lacks is NULL there; columns in order of first appearance."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring a frame to a declared schema: columns by name, in its order and types, the rest dropped."""
    return df.to(schema)


def rows_to_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A handful of in-memory records under a declared schema (rules, mappings; data is read, not passed)."""
    return spark.createDataFrame(rows, schema)


def session_settings(spark: SparkSession) -> DataFrame:
    return spark.sql("SET -v").select("key", "value")
