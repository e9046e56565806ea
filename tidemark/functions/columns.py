"""Reusable column expressions for keys, measures, paths and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

EXACT = T.DecimalType(38, 6)

# The CVSS severity bands (lowest score of each band).
SEVERITY_BANDS = (("Critical", 9.0), ("High", 7.0), ("Medium", 4.0))
LOWEST_SEVERITY = "Low"


def col(name: str | Column) -> Column:
    """A column by literal name; the name may hold spaces or dots."""
    return F.col("`" + name.replace("`", "``") + "`") if isinstance(name, str) else name


def is_blank(value: str | Column) -> Column:
    """NULL, empty or whitespace only."""
    return col(value).isNull() | (F.trim(col(value).cast("string")) == "")


# -- exact sums ------------------------------------------------------------------
# Spark keeps the running sum of a decimal with more than 18 digits as a big-number
# object per group. A decimal of up to 15 digits is a whole number of its smallest
# units that also fits a double, so it can be summed as two bigints: the units above
# and below 2**20. The sums stay exact and cannot overflow before 8.7e12 rows.
# The scale is bounded too, so that putting the limbs together fits 38 digits.
_LIMB_BITS = 20
_MAX_DIGITS = 15
_MAX_SCALE = 8


def narrow_decimal(data_type: T.DataType) -> bool:
    return (isinstance(data_type, T.DecimalType) and data_type.precision <= _MAX_DIGITS
            and data_type.scale <= _MAX_SCALE)


def limbs(value: Column, data_type: T.DecimalType) -> tuple[Column, Column]:
    """A narrow decimal as (units // 2**20, units % 2**20)."""
    if data_type.scale == 0:
        units = value.cast("bigint")
    else:
        units = F.floor(value.cast("double") * F.lit(float(10 ** data_type.scale)) + F.lit(0.5))
    return F.shiftright(units, _LIMB_BITS), units.bitwiseAND(F.lit((1 << _LIMB_BITS) - 1))


def from_limbs(high: Column, low: Column, scale: int) -> Column:
    """The decimal that two limb sums stand for."""
    units = (high.cast("decimal(20,0)") * F.lit(1 << _LIMB_BITS).cast("decimal(7,0)")
             + low.cast("decimal(20,0)"))
    if scale:
        units = units * F.lit("0." + "0" * (scale - 1) + "1").cast(T.DecimalType(scale, scale))
    return units.cast(T.DecimalType(38, scale))


def exact_sum(df: DataFrame, name: str) -> Column:
    """The sum of a column; exact for decimals, and cheap for narrow ones."""
    data_type = df.schema[name].dataType
    if not narrow_decimal(data_type):
        return F.sum(col(name))
    high, low = limbs(col(name), data_type)
    return from_limbs(F.sum(high), F.sum(low), data_type.scale)


def exact_avg(df: DataFrame, name: str) -> Column:
    """The mean of a column as a double; for decimals from their exact sum."""
    if not isinstance(df.schema[name].dataType, T.DecimalType):
        return F.avg(col(name))
    return F.try_divide(exact_sum(df, name).cast("double"), F.count(col(name)))


def severity_band(score: str | Column) -> Column:
    """The severity a CVSS score must carry (NULL scores give NULL)."""
    chain = F.when(col(score).isNull(), F.lit(None).cast("string"))
    for name, floor in SEVERITY_BANDS:
        chain = chain.when(col(score) >= F.lit(floor).cast("decimal(3,1)"), name)
    return chain.otherwise(LOWEST_SEVERITY)


def path_filename(path: str | Column) -> Column:
    return F.try_element_at(F.split(col(path), "/"), F.lit(-1))


def path_class(path: str | Column) -> Column:
    """The parent folder, which holds the document's shipped class."""
    return F.try_element_at(F.split(col(path), "/"), F.lit(-2))


def document_identity(doc_class: str | Column, filename: str | Column) -> Column:
    return F.concat_ws("/", col(doc_class), col(filename))


def describe_identifier(name: str | Column) -> Column:
    """``net_sales`` -> ``Net sales``."""
    words = F.trim(F.replace(col(name), F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substr(words, F.lit(1), F.lit(1))),
                    F.lower(F.substr(words, F.lit(2))))


def normalize_reference(name: str | Column) -> Column:
    """A table reference without quotes, backticks or spaces, in lower case."""
    return F.lower(F.regexp_replace(col(name), r"[`\"'\s]", ""))


def portable(df: DataFrame) -> DataFrame:
    """Report types any SQL engine prints alike.

    Dates and timestamps become ISO text, decimals doubles, and small integers
    bigints; names and order stay.
    """
    out = []
    for field in df.schema.fields:
        column = col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        out.append(column.alias(field.name))
    return df.select(*out)
