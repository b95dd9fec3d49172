"""The run: load what is pending in every output, or reprocess chosen months.

An output that fails is recorded and does not stop the others. The audit table gets one row per
output and period, in one append per execution. Each execution has a run id, a log and prepared
dimensions of its own, and leaves no scratch files behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmart.functions.dates import day_of_key
from reelmart.functions.fixed_values import INITIAL_DATE
from reelmart.functions.titles import TitleClause
from reelmart.loading import periods as P
from reelmart.loading.tables import create_output, drop_periods, periods_of, replace_periods, require_output
from reelmart.plans.dimensions import Dimensions
from reelmart.plans.registry import OUTPUTS, Output
from reelmart.schemas import AUDIT_DDL
from reelmart.sources.inputs import Inputs

LOADED, NOTHING_NEW, FAILED = "loaded", "nothing new", "failed"


@dataclass
class Run:
    """One run over the outputs named in ``tables`` (output name to table name)."""

    spark: SparkSession
    inputs: Inputs
    title_rules: Iterable[TitleClause]
    tables: Mapping[str, str]
    audit_table: str
    initial: str = INITIAL_DATE
    strict_max: bool = False
    run_id: str = field(init=False, default="")

    def __post_init__(self):
        self.title_rules = list(self.title_rules)
        self._begin()

    def _begin(self) -> None:
        self.run_id = uuid.uuid4().hex
        self.dims = Dimensions(self.inputs, self.title_rules, keep=True)
        self.log: list[tuple] = []
        self._latest: dict[str, DataFrame] = {}

    def create_tables(self, root: str | None = None) -> None:
        """Create absent outputs and the audit table, below ``root`` if given."""
        for name, table in self.tables.items():
            create_output(self.spark, OUTPUTS[name], table, f"{root}/{name}" if root else None)
        where = f"LOCATION '{root}/audit'" if root else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.audit_table} ({AUDIT_DDL}) USING parquet {where}")

    def execute(self, months_to_reprocess: str | None = None, reprocess_all: bool = False) -> DataFrame:
        """Load all outputs; returns this run's audit rows.

        ``months_to_reprocess`` lists first days of months, e.g. ``"2025-01-01, 2025-03-01"``. Those
        months are rebuilt, or with ``reprocess_all`` everything from the earliest of them on. The
        daily output is not reprocessed.
        """
        self._begin()
        months = sorted(m.strip() for m in (months_to_reprocess or "").split(",") if m.strip())
        try:
            for name, table in self.tables.items():
                output = OUTPUTS[name]
                try:
                    require_output(self.spark, table)
                    if not months:
                        self._load(output, table, self._pending(output, table).collect())
                    elif not output.daily:
                        self._reload(output, table, months, reprocess_all)
                except Exception as error:  # recorded; the other outputs still run
                    self._record(output, None, None, FAILED, None, f"{type(error).__name__}: {error}")
            return self._write_audit()
        finally:
            self.dims.release()

    def _source(self, output: Output) -> DataFrame:
        """The latest day of the output's input, as a one-row table: a fact is searched for it once a run."""
        if output.input not in self._latest:
            latest = self.inputs.latest(output.input, output.input_date)
            if latest is None:
                raise ValueError(f"input {output.input} has no {output.input_date}")
            self._latest[output.input] = self.spark.createDataFrame([(latest,)], f"{output.input_date} int")
        return self._latest[output.input]

    def _present(self, output: Output, table: str) -> DataFrame:
        """The periods that need no loading: those with rows, and those once loaded without any."""
        logged = self.spark.table(self.audit_table)
        empty = logged.where((F.col("OUTPUT") == output.name) & (F.col("STATUS") == LOADED) & (F.col("ROWS") == 0))
        present = [(day,) for day in periods_of(self.spark, output, table)]
        return self.spark.createDataFrame(present, f"{output.period} date").union(empty.select("PERIOD_END"))

    def _pending(self, output: Output, table: str) -> DataFrame:
        source, loaded = self._source(output), self._present(output, table)
        if output.daily:
            bounds = P.day_bounds(source, output.input_date, loaded, output.period, self.initial)
            return bounds.where("START_DATE <= LATEST_DATE").toDF("PERIOD_START", "PERIOD_END")
        return P.pending_months(source, output.input_date, loaded, output.period, self.initial, self.strict_max)

    def _reload(self, output: Output, table: str, months: list[str], onwards: bool) -> None:
        """Load the months anew, and only then clear those of them that have no rows any more.

        The load replaces whole periods, so readers see the old rows until the new ones are there,
        and a load that fails loses nothing.
        """
        first = date.fromisoformat(months[0])
        if onwards:
            bounds = self._source(output).select(F.lit(first).alias("START_DATE"), day_of_key(output.input_date).alias("LATEST_DATE"))
            calendar = P.month_calendar(bounds).collect()
        else:
            chosen = self.spark.createDataFrame([(m,) for m in months], "m string").select(F.col("m").cast("date"))
            calendar = chosen.select(F.trunc("m", "MM").alias("PERIOD_START"), F.last_day("m").alias("PERIOD_END")).distinct().collect()
        written = self._load(output, table, calendar)
        asked = {d.PERIOD_END for d in calendar}
        stale = [d for d in periods_of(self.spark, output, table) if (d >= first if onwards else d in asked) and d not in written]
        drop_periods(self.spark, output, table, stale)

    def _load(self, output: Output, table: str, calendar: list[Row]) -> dict[date, int]:
        """All periods in one job: the month is part of the key and of the layout. Returns the rows of periods that have any."""
        days = sorted((d.PERIOD_START, d.PERIOD_END) for d in calendar)
        if not days:
            self._record(output, None, None, NOTHING_NEW, 0, None)
            return {}
        rows = output.build(self.dims, P.as_periods(days))
        written = replace_periods(rows, output, table, [] if output.daily else [end for _, end in days])
        if output.daily:
            self._record(output, days[0][0], days[-1][1], LOADED, written.rows, None)
        else:
            for start, end in days:
                self._record(output, start, end, LOADED, written.by_period.get(end, 0), None)
        return written.by_period

    def _record(self, output: Output, start: date | None, end: date | None, status: str, rows, message) -> None:
        now = datetime.now(timezone.utc)
        self.log.append((self.run_id, output.name, start, end, status, rows, message, now))

    def _write_audit(self) -> DataFrame:
        rows = self.spark.createDataFrame(self.log, T.StructType.fromDDL(AUDIT_DDL)).coalesce(1)
        rows.write.insertInto(self.audit_table)
        return self.spark.table(self.audit_table).where(F.col("RUN_ID") == self.run_id)
