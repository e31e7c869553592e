"""User-defined function surface (survey 2.14, N01 to N03).

Native expressions come first; these are the Arrow-batched forms for
bodies that cannot be written as expressions.  No row-at-a-time Python
UDF is used on a hot path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

# Fixed value: what separates words for the word counters.
BLANKS = r"[^ \t\n\r\f]+"


@pandas_udf(LongType())
def count_words(text: pd.Series) -> pd.Series:
    """N01 scalar: words per text, vectorised over an Arrow batch."""
    return text.str.count(BLANKS).astype("int64")


def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N01 table function (flat-map) for ``mapInPandas`` over (key, text):
    one row per token with its place in the text, a batch at a time."""
    for b in batches:
        key, text = b.columns
        parts = b.dropna(subset=[text]).assign(token=lambda d: d[text].str.split(" "))[[key, "token"]].reset_index(drop=True)
        rows = parts.explode("token")
        rows["position"] = rows.groupby(level=0).cumcount().astype("int32")
        yield rows[rows["token"] != ""]


class MeanAggregate:
    """N02 custom aggregate as its steps over a frame of many keys at once:
    ``add`` makes an accumulator per key from rows, ``merge`` one from
    several, ``result`` reads it off."""

    fields = "total double, n long"

    @staticmethod
    def add(rows: pd.DataFrame, key: str, value: str) -> pd.DataFrame:
        return rows.groupby(key, dropna=False)[value].agg(total="sum", n="count").reset_index()

    @staticmethod
    def merge(accumulators: pd.DataFrame, key: str) -> pd.DataFrame:
        return accumulators.groupby(key, dropna=False, as_index=False).sum()

    @staticmethod
    def result(total: pd.Series, n: pd.Series) -> pd.Series:
        return total / n.where(n > 0)


def custom_aggregate(df: DataFrame, key: str, value: str, agg, out: str = "result") -> DataFrame:
    """N02 with partial merging: each Arrow batch adds its rows to one
    accumulator per key before the shuffle, so a hot key sends an
    accumulator per batch, not its rows.  A task then merges the batches it
    gets into one accumulator per key; it holds its keys, never their rows."""
    names = [f.split()[0] for f in agg.fields.split(", ")]
    schema = f"{key} {dict(df.dtypes)[key]}, {agg.fields}"

    def partial(batches):
        for b in batches:
            yield agg.add(b, key, value)

    def merged(batches):
        held = None
        for b in batches:
            held = agg.merge(b if held is None else pd.concat([held, b]), key)
        if held is not None:
            yield held

    parts = df.select(key, value).mapInPandas(partial, schema).repartition(key)
    read = pandas_udf(agg.result, "double")
    return parts.mapInPandas(merged, schema).select(key, read(*[F.col(n) for n in names]).alias(out))


def median_of_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """N03 body: size and median of one (window, key) group."""
    return pd.DataFrame({"window_start": [pdf["window_start"].iloc[0]], "event_type": [pdf["event_type"].iloc[0]],
                         "n": [len(pdf)], "median": [float(pdf["value"].median())]})
