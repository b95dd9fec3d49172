"""Which mart fills which output, from which input, by which date."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from reelmart.operators.facts import Periods
from reelmart.plans import marts
from reelmart.plans.dimensions import Dimensions


@dataclass(frozen=True)
class Output:
    name: str
    build: Callable[[Dimensions, Periods], DataFrame]
    input: str
    input_date: str
    period: str = "MONTH"

    @property
    def daily(self) -> bool:
        return self.period == "DATE"


OUTPUTS = {
    o.name: o
    for o in [
        Output("monthly_video", lambda d, p=None: marts.video_mart(d, "monthly", p), "basic", "REPORTING_DATE"),
        Output("demographics", marts.demographics_mart, "demographics", "REPORTING_DATE"),
        Output("traffic", marts.traffic_mart, "combined", "DATE"),
        Output("device", marts.device_mart, "combined", "DATE"),
        Output("region", marts.region_mart, "basic", "REPORTING_DATE"),
        Output("daily_video", lambda d, p=None: marts.video_mart(d, "daily", p), "basic", "REPORTING_DATE", "DATE"),
    ]
}
