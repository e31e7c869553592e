"""Scalar functions (survey 2.8, H01 to H11).  All are built-in column
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's separators for tokenising.
SEPARATORS = {
    "space": " ",
    "comma": ",",
    "non_word": r"\W+",
    "ctrl_a": r"\^A",
    "dash": "-",
    "colon": ":",
    "tab": "\t",
}


def tokenize(text: Column, pattern: str = " ", lower: bool = False) -> Column:
    """Array of tokens split on a regex; empty tokens removed."""
    src = F.lower(text) if lower else text
    return F.filter(F.split(src, pattern), lambda t: t != "")


def build_text(parts: Sequence[Column], sep: str | None = None) -> Column:
    """Concatenation, or a join with a separator."""
    return F.concat_ws(sep, *parts) if sep is not None else F.concat(*parts)


def clean_long(text: Column) -> Column:
    """``trim.toLong`` that gives null on a bad value instead of failing."""
    return F.trim(text).try_cast("long")


def minute_prefix(text_time: Column) -> Column:
    """``substr(eventTime, 0, 16)``: the yyyy-MM-dd HH:mm prefix."""
    return F.substring(text_time, 1, 16)


def parse_json(text: Column, schema: str) -> Column:
    """JSON text to a struct or map."""
    return F.from_json(text, schema)


def to_json_record(cols: Sequence[str], rename: Mapping[str, str] | None = None) -> Column:
    """A record serialised as JSON, optionally with other field names
    (snake case in the report)."""
    rename = rename or {}
    return F.to_json(F.struct(*[F.col(c).alias(rename.get(c, c)) for c in cols]))


def invert_csv_map(df: DataFrame, key: str, csv_values: str, out_key: str, out_value: str) -> DataFrame:
    """Area -> "c1,c2" inverted to country -> area."""
    return df.select(F.explode(F.split(F.col(csv_values), ",")).alias(out_key), F.col(key).alias(out_value))


def indicator_columns(df: DataFrame, col: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """One 0/1 long column per value, set where ``col`` equals it."""
    for v in values:
        df = df.withColumn(prefix + v.lower(), F.when(F.col(col) == v, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return df


def composite_key(parts: Sequence[Column], as_text: bool = True) -> Column:
    """Parts concatenated without separator (the source's byte key), or
    a struct key, which cannot collide."""
    if as_text:
        return F.concat(*[p.cast("string") for p in parts])
    return F.struct(*parts)


def magnitude_bucket(v: Column, n: int) -> Column:
    """Bucket i holds values below 10^(i+1) for i < n-1, the last
    bucket holds the rest; n <= 0 gives 0."""
    if n <= 0:
        return F.lit(0)
    expr = F.lit(n - 1)
    for i in reversed(range(n - 1)):
        expr = F.when(v < F.lit(10 ** (i + 1)), F.lit(i)).otherwise(expr)
    return expr.cast("int")


def int_div(a: Column, b: Column) -> Column:
    """Truncated integer division (``a div b``) in decimals, so exact on
    longs; a fraction counts to six places."""
    return F.call_function("div", a.cast("decimal(38,6)"), b.cast("decimal(38,6)"))
