"""Votes against the census."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.checks import participation


def by_place(votes: DataFrame, place: list[str], value: str = "votos") -> DataFrame:
    return votes.groupBy(*place).agg(F.sum(value).alias("votos"), F.count(F.lit(1)).alias("mesas"))


def check_places(votes: DataFrame, census: DataFrame, place: list[str], high: float = 0.95) -> DataFrame:
    """Votes of each place against its eligible voters; places without a census row are flagged, not dropped."""
    joined = by_place(votes, place).join(census.select(*place, F.col("total").alias("habilitados")), place, "left")
    ratio, flag = participation(F.col("votos"), F.col("habilitados"), high)
    return joined.withColumn("participacion", ratio).withColumn("bandera", flag)


def review_order(places: DataFrame, *tiebreak: str) -> DataFrame:
    rank = F.when(F.col("bandera") == "EXCEDE", 0).when(F.col("bandera") == "ALTO", 1).otherwise(2)
    return places.orderBy(rank, F.desc(F.coalesce("participacion", F.lit(0.0))), *tiebreak)


def over_cap(votes: DataFrame, table: list[str], cap: int, value: str = "votos") -> DataFrame:
    """Tables with more votes than an explicit cap; keys sort as text."""
    return votes.where(F.col(value) > cap).withColumn("exceso", F.col(value) - cap).orderBy(*[F.col(c).cast("string") for c in table])


def without_votes(votes: DataFrame, census: DataFrame, place: list[str]) -> DataFrame:
    return census.join(votes.select(*place).distinct(), place, "left_anti")


def summary(census: DataFrame) -> DataFrame:
    each = F.col("total") / F.greatest("mesas", F.lit(1))
    return census.agg(F.count(F.lit(1)).alias("puestos"), F.sum("total").alias("habilitados"), F.sum("mesas").alias("mesas"), F.round(F.sum("total") / F.greatest(F.sum("mesas"), F.lit(1)), 2).alias("media_por_mesa"), F.round(F.max(each), 2).alias("max_media_por_mesa"))
