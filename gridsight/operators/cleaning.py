"""Whole-table cleaning steps: each is one projection or filter, so a chain stays one stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from gridsight.functions import parsing


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def null_placeholders(df: DataFrame, placeholders=parsing.PLACEHOLDERS) -> DataFrame:
    """Placeholder texts become NULL in every string column."""
    return df.select(
        *[
            parsing.null_placeholder(quoted(f.name), placeholders).alias(f.name)
            if isinstance(f.dataType, StringType)
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the listed columns; names the table does not have are ignored."""
    return df.drop(*names)


def keep_active(df: DataFrame, status: str, active: str = "ACT") -> DataFrame:
    """Keep rows with the active status (NULL is not active) and drop the status column."""
    return df.filter(quoted(status) == active).drop(status)


def keep_digits_or_null(df: DataFrame, column: str) -> DataFrame:
    """Remove rows whose text is neither digits nor NULL, then type the column as double."""
    return df.filter(parsing.digits_or_null(quoted(column))).withColumn(
        column, parsing.finite(quoted(column))
    )


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed columns; what does not fit the type, or is not a finite number, becomes NULL."""
    return df.withColumns(
        {
            c: parsing.finite(quoted(c)) if t == "double" else quoted(c).try_cast(t)
            for c, t in types.items()
        }
    )


def add_sums(df: DataFrame, sums: dict[str, tuple[str, str]]) -> DataFrame:
    """New columns ``a + b``; NULL where either side is NULL."""
    return df.withColumns({n: quoted(a) + quoted(b) for n, (a, b) in sums.items()})


def billing_calendar(df: DataFrame, yyyymm: str = "billing_month") -> DataFrame:
    """``YYYYMM`` text -> year, month and the month's first day, all read from the text."""
    text = quoted(yyyymm)
    return df.withColumns(
        {
            "year": parsing.billing_year(text),
            "month": parsing.billing_month(text),
            yyyymm: parsing.billing_month_date(text),
        }
    )


def payment_calendar(df: DataFrame, paid_at: str) -> DataFrame:
    paid = quoted(paid_at).cast("date")
    return df.withColumns(
        {"payment_date": paid, "payment_year": F.year(paid), "payment_month": F.month(paid)}
    )


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def all_present_and_nonzero(df: DataFrame, columns: list[str]) -> DataFrame:
    keep = F.lit(True)
    for c in columns:
        keep = keep & quoted(c).isNotNull() & (quoted(c) != 0)
    return df.filter(keep)


def zero_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.lit(0.0) for n in names})


def surrogate_key(df: DataFrame, natural_key: list[str], name: str = "row_key") -> DataFrame:
    """A key that is the same in every run: 128 bits, so that it stays unique at 10^12 rows.

    Each part is written with its length, and NULL as ``-``, so that different natural keys never
    give the same text.
    """
    texts = [quoted(c).cast("string") for c in natural_key]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def complaint_season(df: DataFrame, month: str = "month") -> DataFrame:
    """Billing months for which complaints exist: April to September."""
    return df.filter(quoted(month).between(4, 9))


def month_slice(df: DataFrame, at: str, month: str) -> DataFrame:
    """Rows of one ``YYYY-MM``, as a half-open range so that files and partitions are pruned."""
    start = F.to_date(F.lit(f"{month}-01"))
    return df.filter((quoted(at) >= start) & (quoted(at) < F.add_months(start, 1)))


def before_period(df: DataFrame, period: str, target: Column) -> DataFrame:
    return df.filter(quoted(period) < target)


def feature_columns(df: DataFrame, exclude: list[str], contains: list[str] | None = None) -> list[str]:
    """Names of model inputs: all but ids and labels, or only those holding one of the words."""
    names = [c for c in df.columns if c not in exclude]
    if contains:
        names = [c for c in names if any(word in c for word in contains)]
    return names


def profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, values present, and text values that are not numbers.

    The table is read once; only the finished one-row aggregate is turned into rows.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        value = quoted(f.name)
        counts.append(F.count(value).alias(f"present{i}"))
        bad = (
            F.count_if(value.isNotNull() & value.try_cast("double").isNull())
            if isinstance(f.dataType, StringType)
            else F.lit(0).cast("bigint")
        )
        counts.append(bad.alias(f"bad{i}"))
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("rows"),
            F.col(f"present{i}").alias("present"),
            F.col(f"bad{i}").alias("not_numeric"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def before_and_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns of a table before and after cleaning, in one row."""
    rows_after = after.agg(F.count(F.lit(1)).alias("n")).scalar()
    return before.agg(F.count(F.lit(1)).alias("rows_before")).select(
        "rows_before",
        rows_after.alias("rows_after"),
        F.lit(len(before.columns)).alias("columns_before"),
        F.lit(len(after.columns)).alias("columns_after"),
    )


def distinct_names(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """Names of two sources side by side, to find spellings that do not match."""
    a = left.select(quoted(left_name).alias("name")).distinct().withColumn("in_left", F.lit(1))
    b = right.select(quoted(right_name).alias("name")).distinct().withColumn("in_right", F.lit(1))
    return a.join(b, "name", "full").fillna(0, ["in_left", "in_right"])
