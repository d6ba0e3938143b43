"""Small string and number helpers of the reports, as columns or driver-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combo_symbols(n: int) -> list[str]:
    """A, B, ... Z, AA, AB, ..."""
    out = []
    for i in range(n):
        name, k = "", i
        while True:
            name, k = chr(65 + k % 26) + name, k // 26 - 1
            if k < 0:
                break
        out.append(name)
    return out


def collapse(columns, sep: str = "", fill: str | None = "NA"):
    """Row-wise concatenation; nulls become `fill`, or vanish if that is None."""
    return F.concat_ws(sep, *[F.col(c).cast("string") if fill is None else F.coalesce(F.col(c).cast("string"), F.lit(fill)) for c in columns])


def thousands(x):
    return F.format_number(x, 0)


def expand_positions(df: DataFrame, column: str) -> DataFrame:
    """A row per single position of chr:strand:pos; strand * stands for both, pos may be a range a-b."""
    parts = F.split(column, ":")
    strands = F.when(parts[1] == "*", F.array(F.lit("+"), F.lit("-"))).otherwise(F.array(parts[1]))
    ends = F.split(parts[2], "-")
    spread = df.withColumn("__strand", F.explode(strands)).withColumn("__pos", F.explode(F.sequence(ends[0].cast("long"), F.element_at(ends, -1).cast("long"))))
    return spread.withColumn("position", F.concat_ws(":", parts[0], F.col("__strand"), F.col("__pos"))).drop("__strand", "__pos")
