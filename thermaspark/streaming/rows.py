"""Row-local steps on streams: masks, quality flags and corrections hold no state, so a streaming frame goes through them as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import physics as P
from ..operators import mask


def corrected_stream(s3: DataFrame, gain: float | None, offset: float | None, directional: float | None) -> DataFrame:
    out = mask.mask_clouds(s3).withColumn("quality", mask.quality_flag(F.col("confidence_in"), F.col("lst_uncertainty")))
    return out.withColumn("lst", P.correct_lst(F.col("lst"), F.col("vza"), gain, offset, directional))


def daily_cloud_share(s3: DataFrame, late: str = "1 day") -> DataFrame:
    """Cloudy percentage per acquisition and UTC day; a day is final once the watermark has passed it. Needs a timestamp column acq_ts."""
    cloudy = F.coalesce(mask.flag(F.col("confidence_in"), "summary_cloud"), F.lit(0))
    day = F.window("acq_ts", "1 day")
    return s3.withWatermark("acq_ts", late).groupBy(day, "acq_id").agg((100 * F.avg(cloudy)).alias("cloud_pct")).select(F.to_date("window.start").alias("day"), "acq_id", "cloud_pct")
