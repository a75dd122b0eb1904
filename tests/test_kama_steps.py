"""The adaptive mean takes the steps of a recursion over rows: equal bits, so equal rounding where a value lies on a half."""

import random

from pyspark.sql import functions as F

from barlake.operators import analytics, continued

QUICK, CALM = 2.0 / 3, 2.0 / 31


def recursion(x):
    out, y = [None] * 9, float(x[9])
    for i in range(9, len(x)):
        if i > 9:
            moves = sum(abs(x[j] - x[j - 1]) for j in range(i - 9, i + 1))
            steep = (abs(x[i] - x[i - 10]) / moves if moves else 0.0) * (QUICK - CALM) + CALM
            y = y + steep * steep * (x[i] - y)
        out.append(y)
    return out


def test_kama_and_its_continuation_equal_a_recursion_bit_by_bit(spark):
    draw = random.Random(4)
    # two of the keys have more rows than a stretch of the fold
    series = {f"s{n}": [draw.randint(1, 50) for _ in range(600 if n < 2 else 40)] for n in range(40)}
    day = F.timestamp_add("DAY", F.col("n"), F.lit("2000-01-01").cast("timestamp_ntz"))
    bars = spark.createDataFrame(
        [(s, n, v) for s, x in series.items() for n, v in enumerate(x)], "stock string, n int, volume bigint",
    ).select("stock", day.alias("date"), "volume")
    expected = [y for s in sorted(series) for y in recursion(series[s])]

    def means(df):
        return [r["m"] for r in df.orderBy("stock", "date").collect()]

    assert means(analytics.kama(bars, "volume", "m")) == expected
    first = F.col("date") < F.lit("2000-01-20").cast("timestamp_ntz")
    early = continued.continue_kama(spark, bars.filter(first), None, "volume", "m")
    late = continued.continue_kama(spark, bars.filter(~first), early.state, "volume", "m")
    assert means(early.rows.unionByName(late.rows)) == expected
