"""Small column helpers."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts of a control value that mean "nothing set".
UNSET = ("", "None")
# All white space, not just blanks: tabs and line ends come with hand-edited control rows.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def name(column: str) -> Column:
    """A column by its exact name, also when the name holds dots or spaces."""
    return F.col("`" + column.replace("`", "``") + "`")


def names(columns: Sequence[str]) -> list[Column]:
    return [name(c) for c in columns]


def resolve(column: str, columns: Sequence[str]) -> str | None:
    """The spelling of ``column`` in ``columns``, whatever the case; None if missing."""
    if column in columns:
        return column
    return next((c for c in columns if c.lower() == column.lower()), None)


def resolve_keys(keys: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Key columns in the spelling of ``columns``, each once; a missing one is an error."""
    missing = [k for k in keys if resolve(k, columns) is None]
    if missing:
        raise ValueError(f"key columns that the table does not have: {missing}")
    return list(dict.fromkeys(resolve(k, columns) for k in keys))


def split_keys(text: Column) -> Column:
    """``'a | b'`` to ``['a', 'b']``: trimmed, blanks dropped; unset gives no keys."""
    parts = F.filter(
        F.transform(F.split(text, r"\|"), lambda part: F.btrim(part, F.lit(WHITE_SPACE))),
        lambda part: part != "",
    )
    nothing = F.array().cast("array<string>")
    return F.when(text.isNull() | text.isin(*UNSET), nothing).otherwise(parts)


def strict_literal(value: str, dtype: T.DataType, what: str) -> Column:
    """``value`` in the given type; a malformed one fails the query in every SQL mode.

    A well-formed value folds to a plain literal, so filters on it still reach the scan.
    """
    message = f"{what}: {value!r} is not a valid {dtype.simpleString()}"
    return F.coalesce(F.lit(value).try_cast(dtype), F.raise_error(F.lit(message)))


def all_set(columns: Sequence[str]) -> Column:
    """True where every one of the columns has a value."""
    return reduce(lambda a, b: a & b, [name(c).isNotNull() for c in columns])


def split_by_null_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and rows with a NULL in it.

    The second kind can never match anything, so it stays out of joins and shuffles,
    where all of it would meet in one task.
    """
    complete = all_set(keys)
    return df.filter(complete), df.filter(~complete)


def all_nullable(dtype: T.DataType) -> T.DataType:
    """The type with every field, element and value nullable, as files store it."""
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(f.name, all_nullable(f.dataType)) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(all_nullable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(all_nullable(dtype.keyType), all_nullable(dtype.valueType))
    return dtype


def merged_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """The columns of both, as files store them; a name in another case is the same column."""
    known = {f.lower() for f in first.names}
    more = [f for f in second.fields if f.name.lower() not in known]
    return all_nullable(T.StructType([*first.fields, *more]))
