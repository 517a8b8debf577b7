"""Projections from documents to declared rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.columns import clean_name, decoded, first_of, number_of, second_of

Transform = Callable[[DataFrame], DataFrame]
COMMA = "','"


def decode_document(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, decoded(F.col(column)))


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _text(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to leaf columns with dotted names; arrays stay as values."""

    def leaves(fields: T.StructType, at: tuple[str, ...]) -> list[str]:
        found: list[str] = []
        for field in fields:
            here = (*at, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                found.append(f"{_quoted(*here)} AS {_quoted('.'.join(here))}")
        return found

    return df.selectExpr(*leaves(df.schema, ()))


def clean_column_names(df: DataFrame) -> DataFrame:
    """Clean every label; two labels that become one raise."""
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Column names collide after cleaning: {', '.join(twice)}")
    return df.toDF(*names)


def rename_id(df: DataFrame, target: str) -> DataFrame:
    return df.withColumnRenamed("id", target)


def ids_to_string(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def with_record_count(df: DataFrame, column: str = "data") -> DataFrame:
    """Rows a document will give, 0 for an empty one; taken before the explode."""
    count = F.coalesce(F.array_size(column), F.lit(0)).cast("long")
    return df.withColumn("record_count", count)


def explode_samples(df: DataFrame, column: str = "data") -> DataFrame:
    """One row per array element with a 1-based `index`; the other columns repeat.

    A null or empty array gives no rows, a null element gives a row.
    """
    others = [c for c in df.columns if c != column]
    exploded = df.select(*others, F.posexplode(column).alias("_pos", column))
    return exploded.select(
        *others, (F.col("_pos") + 1).cast("long").alias("index"), column
    )


def bool_samples_to_double(df: DataFrame, column: str = "data") -> DataFrame:
    """Array of sample texts to doubles, true/false to 1.0/0.0."""
    return df.withColumn(column, F.transform(column, number_of))


def split_latlng(df: DataFrame, column: str = "data") -> DataFrame:
    """A pair per row to `latitude` and `longitude`; a short or null pair gives nulls."""
    pair = F.col(column)
    return df.withColumns({"latitude": first_of(pair), "longitude": second_of(pair)}).drop(column)


def split_optional_pairs(df: DataFrame) -> DataFrame:
    """Start and end pairs of an activity to four columns; null or empty gives nulls."""
    parts: dict[str, Column] = {}
    for end in ("start", "end"):
        pair = F.col(f"{end}_latlng")
        parts[f"{end}_latitude"] = first_of(pair)
        parts[f"{end}_longitude"] = second_of(pair)
    return drop_columns(df.withColumns(parts), "start_latlng", "end_latlng")


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def conform(
    df: DataFrame,
    schema: T.StructType,
    keep: tuple[str, ...] = (),
    extra: str | None = "_extra",
) -> DataFrame:
    """Project to the declared columns with `try_cast`; absent ones are null.

    Text of a whole number is an integer however it is written.

    Adds `_violations`, the comma-joined names of columns whose value would not cast or
    that are required and null, empty when there are none. Undeclared columns go to the
    `extra` map as text, but for the `keep` columns, which pass unchanged.
    """
    given = {f.name: f.dataType for f in df.schema}
    cast, broken = [], []
    for field in schema:
        name = _quoted(field.name)
        raw = name if field.name in given else "NULL"
        value = f"try_cast({raw} AS {field.dataType.simpleString()})"
        if field.dataType == T.LongType() and given.get(field.name) == T.StringType():
            exact = f"try_cast({raw} AS DECIMAL(38, 9))"  # `178.0` is a whole number, `1.5` isn't
            value = f"coalesce({value}, IF({exact} = floor({exact}), try_cast({exact} AS BIGINT), NULL))"
        cast.append(f"{value} AS {name}")
        if not field.nullable:
            broken.append(f"IF({value} IS NULL, {_text(field.name)}, NULL)")
        elif given.get(field.name, field.dataType) != field.dataType and field.dataType != T.StringType():
            broken.append(f"IF({raw} IS NOT NULL AND {value} IS NULL, {_text(field.name)}, NULL)")
    columns = [*map(_quoted, keep), *cast, f"concat_ws({', '.join([COMMA, *broken])}) AS _violations"]
    if extra:
        others = [c for c in df.columns if c not in (*schema.names, *keep)]
        entries = ", ".join(f"{_text(c)}, CAST({_quoted(c)} AS STRING)" for c in others)
        columns.append(f"CAST({f'map({entries})' if others else 'NULL'} AS MAP<STRING, STRING>) AS {extra}")
    return df.selectExpr(*columns)


def stamp(df: DataFrame, at: datetime, column: str = "metadata_insert_timestamp") -> DataFrame:
    """The same literal load time on every row of a batch."""
    return df.withColumn(column, F.lit(at).cast("timestamp"))


def union_batches(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Bag union by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, first)


# Extension point: transforms of a channel's exploded or flattened rows, in order.
TRANSFORMS: dict[str, list[Transform]] = {
    "latlng": [split_latlng],
    "activity": [split_optional_pairs],
}


def dispatch(channel: str, df: DataFrame, transforms: dict[str, list[Transform]] | None = None) -> DataFrame:
    """Apply the transforms registered for a channel, left to right; none is identity."""
    registry = TRANSFORMS if transforms is None else transforms
    return reduce(DataFrame.transform, registry.get(channel, []), df)
