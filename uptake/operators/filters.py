"""Row filters a dashboard applies."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions.calendar import day


@dataclass(frozen=True)
class Filters:
    """Chosen segments, regions and platforms; an empty choice restricts nothing."""

    segments: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    platforms: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        chosen = (("segment", self.segments), ("region", self.regions), ("product_platform", self.platforms))
        for column, values in chosen:
            if values:
                df = df.where(F.col(column).isin(*values))
        return df


EVERYTHING = Filters()


def as_of(df: DataFrame, month: str) -> DataFrame:
    """Rows of one month; on a stored mart this reads that partition only."""
    return df.where(F.col("month") == day(month))
