"""Watch-list grid with one family of columns per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .filters import pair_members

BUCKETS = 10
NEUTRAL_BUCKET = 5


def month_grid(monthly: DataFrame, watchlist: tuple[str, ...], months: list[int]) -> DataFrame:
    """One row per (country1, country2) cell of the watch list, four columns per month.

    ``monthly`` is already cut to the watch list. Tone is placed in buckets 0…9 between the least and greatest
    mean tone of the frame, article counts as a percentage of their spread; a cell without data gets bucket 5 and
    zeros. The cells come from the watch list alone, so the grid's size does not depend on the data.
    """
    # The frame is read once: pivoted first, so that least and greatest values are taken over the few pairs left.
    wide = monthly.groupBy("country1", "country2").agg(
        *(of(name).alias(f"{label}_{name}") for label, of in (("least", F.min), ("most", F.max)) for name in ("mean_tone", "n_articles")),
        *(F.max(F.when(F.col("month") == month, F.col(name))).alias(f"{name}_{month}")
          for month in months for name in ("mean_tone", "n_articles")))
    everywhere = Window.partitionBy()  # at most as many rows as the watch list has pairs
    low = F.min("least_mean_tone").over(everywhere)
    wide = wide.withColumns({
        "low": low, "tones": F.max("most_mean_tone").over(everywhere) - low,
        "articles": F.max("most_n_articles").over(everywhere) - F.min("least_n_articles").over(everywhere)})

    def bucket(month: int) -> Column:
        return (F.try_divide(F.col(f"mean_tone_{month}") - F.col("low"), "tones") * (BUCKETS - 1)).cast("int")

    def size(month: int) -> Column:
        return (F.try_divide(F.col(f"n_articles_{month}"), "articles") * 100).cast("int")

    wide = wide.select("country1", "country2", *(column.alias(f"{name}_{month}") for month in months for name, column in (
        ("bucket", bucket(month)), ("size", size(month)), ("mean_tone", F.col(f"mean_tone_{month}")),
        ("n_articles", F.col(f"n_articles_{month}")))))
    firsts, seconds = pair_members(watchlist)
    cells = (
        monthly.sparkSession.range(0, 1, 1, 1)
        .select(F.explode(F.lit(firsts)).alias("country1"))
        .select("country1", F.explode(F.lit(seconds)).alias("country2"))
    )
    defaults = {"bucket": NEUTRAL_BUCKET, "size": 0, "mean_tone": 0.0, "n_articles": 0}
    return cells.join(wide, ["country1", "country2"], "left").select(
        "country1", "country2",
        *(F.coalesce(f"{name}_{month}", F.lit(default)).alias(f"{name}_{month}")
          for month in months for name, default in defaults.items()),
    )
