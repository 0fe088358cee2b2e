"""Joins of values with the bands they lie in, without a nested loop.

A band is listed in the bins of its own size, two of them at most (three where rounding adds one); a value looks
into its bin of each size that occurs. So neither a very wide band nor a very narrow one is listed many times, and
what meets is checked exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import splittable_join


def band_join(points: DataFrame, bands: DataFrame, value: str, low: str, high: str) -> DataFrame:
    """All pairs of a row of ``points`` and a row of ``bands`` with ``low`` <= ``value`` <= ``high``, each once.

    The columns of both must differ. Rows with a NULL in one of the three are in no pair, nor are bands that end
    before they begin. A bin in which very many values lie can be split, as the join is one by key.
    """
    span = f"CAST({high} AS double) - CAST({low} AS double)"
    # Sizes are powers of two; there are as many as the widest and the narrowest band lie apart.
    sized = bands.filter(f"{low} <= {high}").withColumn(
        "_size", F.expr(f"CASE WHEN {span} > 0 THEN ceil(log2({span})) ELSE -20 END").cast("int")
    )
    sized = sized.withColumn("_size", F.greatest("_size", F.lit(-20)))
    sizes = sorted(r[0] for r in sized.select("_size").distinct().collect())
    bin_of = "CAST(floor(CAST({} AS double) / pow(2, _size)) AS long)"
    listed = sized.withColumn("_bin", F.expr(f"explode(sequence({bin_of.format(low)}, {bin_of.format(high)}))"))
    every = F.array(*[F.lit(s) for s in sizes]).cast("array<int>")
    looking = points.filter(F.col(value).isNotNull()).withColumn("_size", F.explode(every))
    looking = looking.withColumn("_bin", F.expr(bin_of.format(value)))
    met = splittable_join(looking, listed, ["_size", "_bin"])
    return met.filter(f"{value} BETWEEN {low} AND {high}").drop("_size", "_bin")
