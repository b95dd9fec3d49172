
from __future__ import annotations

import sys
import uuid
import warnings
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import cached_property, reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import ON_DENSE_FACTS, ORACLES  # noqa: E402
from reelmart.functions import buckets as B  # noqa: E402
from reelmart.functions.dates import day_of_key, month_of_key  # noqa: E402
from reelmart.functions.program_ids import program_id  # noqa: E402
from reelmart.functions.titles import (  # noqa: E402
    TitleClause,
    sample_title_rules,
    title_series,
)
from reelmart.loading import periods as P  # noqa: E402
from reelmart.loading.run import Run  # noqa: E402
from reelmart.loading.tables import append, clear_periods, create_output, replace_periods  # noqa: E402
from reelmart.operators import combine as C  # noqa: E402
from reelmart.operators import dimensions as D  # noqa: E402
from reelmart.operators import facts as S  # noqa: E402
from reelmart.operators.lookups import join_lookup  # noqa: E402
from reelmart.operators.title_rules import label_by_rules  # noqa: E402
from reelmart.operators.profile import demo_geo_sum, demo_profile, with_group_total  # noqa: E402
from reelmart.plans import marts as M  # noqa: E402
from reelmart.plans.dimensions import Dimensions  # noqa: E402
from reelmart.plans.registry import OUTPUTS  # noqa: E402
from reelmart.session import materialized, scratch_path  # noqa: E402
from reelmart.sources.inputs import FACTS, INPUT_COLUMNS, Inputs  # noqa: E402
from reelmart.sources.star_adapter import Star  # noqa: E402

_MORE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_MORE_SQL: dict[str, str] = {}
try:
    import corpus_pipeline
    from reelmart.llm.queries import ORACLES as LLM_ORACLES
    from reelmart.llm.queries import QUERIES as LLM_QUERIES
except ImportError as missing:  # the library works without the subpackage, or without a package that only this needs
    warnings.warn(f"queries of the llm subpackage are left out: {missing}", stacklevel=1)
else:
    _MORE = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    _MORE_SQL = {**LLM_ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}

DOCUMENT_RULES = [
    TitleClause(1, "Double the", ("theth",)),
    TitleClause(2, "French sound", ("eaux",)),
    TitleClause(2, "French sound", ("ment ",)),
    TitleClause(3, "With -tion", ("with", "tion"), ("license",)),
    TitleClause(4, "German sound", ("ung",)),
    TitleClause(4, "German sound", ("sch",), ("the",)),
]


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike in both engines: dates as text, decimals as (rounded) doubles."""

    def plain(f: T.StructField):
        c, kind = F.col(f.name), f.dataType
        if isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DecimalType) and kind.scale == 0:
            c = c.cast("long")
        elif isinstance(kind, T.DecimalType):
            c = (c.cast("decimal(38,7)") if kind.scale > 8 else c).cast("double")
        elif isinstance(kind, T.DoubleType):
            c = F.round(c, 8)
        return c.alias(f.name)

    return df.select(*map(plain, df.schema))


class Session:
    """The star in one folder, with inputs and dimensions opened as a query needs them."""

    def __init__(self, spark: SparkSession, folder: str, dense: bool = False):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.star = Star(spark, folder, dense)

    def __getattr__(self, name: str) -> DataFrame:
        return self.star.input(name)

    @cached_property
    def dims(self) -> Dimensions:
        return Dimensions(self.star.inputs(), sample_title_rules())

    @cached_property
    def months(self) -> DataFrame:
        return C.video_measures(self.basic, self.revenue, "monthly")

    @cached_property
    def demo(self) -> DataFrame:
        return C.demo_join(self.basic, self.demographics)

    def demo_formed(self) -> DataFrame:
        titled = D.map_video_title(self.demo, self.metadata, form=True)
        return D.map_channel(titled, self.dims.channels)

    def output_table(self, name: str) -> str:
        """A fresh output table in the shared scratch folder."""
        table = f"mart_{name}_{uuid.uuid4().hex}"
        create_output(self.spark, OUTPUTS[name], table, scratch_path(self.spark, name))
        return table

    def run(self, *names: str) -> Run:
        """A run over fresh tables for the named outputs."""
        tag = uuid.uuid4().hex
        run = Run(
            self.spark,
            self.star.inputs(),
            sample_title_rules(),
            {name: f"mart_{name}_{tag}" for name in names},
            f"mart_audit_{tag}",
        )
        run.create_tables(scratch_path(self.spark, "run"))
        return run


def _checked(audit: DataFrame) -> DataFrame:
    failed = [r.MESSAGE for r in audit.where("STATUS = 'failed'").collect()]
    if failed:
        raise RuntimeError("; ".join(failed))
    return audit


def _video_key(df: DataFrame, *more: str) -> DataFrame:
    return df.select("MONTH", "VIDEO_ID", "CHANNEL_ID", "UPLOADER_TYPE", "GEO", *more)


def _views_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("VIEWS").alias("VIEWS"))


def _named_views(s: Session) -> DataFrame:
    return D.map_channel(S.region_views(s.basic), s.dims.channels)


def _region_flags(s: Session) -> DataFrame:
    by_country = _views_by(s.basic, "COUNTRY_CODE")
    placed = join_lookup(by_country, s.dims.countries, "COUNTRY_CODE", how="inner")
    return placed.select("COUNTRY_CODE", "CONTINENT", "SUB_CONTINENT", *B.region_flags(), "VIEWS")


def _sample_rule_table(s: Session) -> DataFrame:
    rows = [(c.ordinal, c.label, list(c.contains), list(c.lacks), c.equals) for c in sample_title_rules()]
    return s.spark.createDataFrame(
        rows, "ordinal int, label string, contains array<string>, lacks array<string>, equals string"
    )


def _rule_table(s: Session) -> DataFrame:
    """Rules that are data: every benchmark item is a phrase to look for in every document."""
    rules = s.star.table("benchmark").select(
        F.col("item_id").alias("ordinal"),
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("label"),
        F.array(F.lower("text")).alias("contains"),
        F.lit(None).cast("array<string>").alias("lacks"),
        F.lit(None).cast("string").alias("equals"),
    )
    labelled = label_by_rules(s.star.table("documents"), "text", rules, "DOMO_SERIES_NAME")
    return labelled.select("doc_id", "DOMO_SERIES_NAME")


def _date_keys(s: Session) -> DataFrame:
    day = day_of_key("REPORTING_DATE")
    month_start = F.trunc(day, "MM")
    return _views_by(
        s.basic,
        F.col("REPORTING_DATE").alias("DATE_KEY"),
        day.alias("DAY"),
        month_of_key("REPORTING_DATE").alias("MONTH"),
        month_start.alias("MONTH_START"),
        F.add_months(month_start, 1).alias("NEXT_MONTH"),
        F.date_add(day, 1).alias("NEXT_DAY"),
    )


def _loaded_until_march(s: Session) -> DataFrame:
    """An output that holds the months and days up to March 2025, derived from the facts."""
    days = s.basic.where(F.col("REPORTING_DATE") <= 20250331)
    return days.select(month_of_key("REPORTING_DATE").alias("MONTH"), F.lit("2025-03-31").cast("date").alias("DATE"))


def _first_halves(s: Session) -> DataFrame:
    """An output that holds the first half of every year."""
    return s.basic.select(month_of_key("REPORTING_DATE").alias("MONTH")).where(F.month("MONTH") <= 6)


def _sink_append(s: Session) -> DataFrame:
    table = s.output_table("device")
    for _ in range(2):
        append(M.device_mart(s.dims), OUTPUTS["device"], table)
    return s.spark.table(table)


def _sink_replace_month(s: Session) -> DataFrame:
    table, mart = s.output_table("device"), M.device_mart(s.dims)
    replace_periods(mart, OUTPUTS["device"], table)
    march = mart.where(F.col("MONTH") == F.lit("2025-03-31").cast("date"))
    replace_periods(march.withColumn("VIEWS", F.lit(0).cast("long")), OUTPUTS["device"], table)
    return s.spark.table(table)


def _sink_truncate_from(s: Session) -> DataFrame:
    table = s.output_table("device")
    replace_periods(M.device_mart(s.dims), OUTPUTS["device"], table)
    clear_periods(s.spark, OUTPUTS["device"], table, "2025-03-31")
    clear_periods(s.spark, OUTPUTS["device"], table, "2027-01-01", onwards=True)
    return s.spark.table(table)


def _incremental(s: Session) -> DataFrame:
    """Load everything, lose a month, load again: the second run fills the gap."""
    run = s.run("region")
    _checked(run.execute())
    clear_periods(s.spark, OUTPUTS["region"], run.tables["region"], "2026-05-31")
    _checked(run.execute())
    return s.spark.table(run.tables["region"])


def _reprocess(s: Session) -> DataFrame:
    run = s.run("traffic")
    _checked(run.execute())
    _checked(run.execute("2025-03-01, 2026-07-01"))
    _checked(run.execute("2029-01-01", reprocess_all=True))
    table = s.spark.table(run.tables["traffic"])
    return table.withColumn("SERIES_ID", F.col("SERIES_ID").cast("decimal(38,0)").cast("string"))


def _audit(s: Session) -> DataFrame:
    """Two executions of one run: all rows that the audit table then has."""
    run = s.run("device")
    first = _checked(run.execute()).first().RUN_ID
    _checked(run.execute())
    audit = s.spark.table(run.audit_table)
    number = F.when(F.col("RUN_ID") == first, 1).otherwise(2).alias("RUN")
    return audit.select("OUTPUT", "PERIOD_START", "PERIOD_END", "STATUS", "ROWS", number)


def _latest_days(s: Session) -> DataFrame:
    """The latest day of each fact, as a run finds it for facts that lie in Parquet folders."""
    kept = {name: materialized(s.star.input(name), name) for name in FACTS}
    tables = {name: s.star.input(name) for name in INPUT_COLUMNS} | {name: df for name, (df, _) in kept.items()}
    inputs = Inputs.of(tables, {name: folder for name, (_, folder) in kept.items()})
    keys = {o.input: o.input_date for o in OUTPUTS.values()} | {"revenue": "DATE"}
    return s.spark.createDataFrame([(name, inputs.latest(name, keys[name])) for name in FACTS], "INPUT string, LATEST long")


def _refused_cases(s: Session) -> DataFrame:
    """A run with a missing output table and an input without days: both are recorded, the third output is loaded."""
    run = s.run("traffic", "demographics", "device")
    s.spark.sql(f"DROP TABLE {run.tables['traffic']}")
    run.inputs = replace(run.inputs, demographics=run.inputs.demographics.where("REPORTING_DATE < 0"))
    began = datetime.now(timezone.utc)
    audit = run.execute()
    ended = datetime.now(timezone.utc) + timedelta(seconds=1)
    message = F.regexp_replace("MESSAGE", run.tables["traffic"], "TABLE").alias("MESSAGE")
    within = F.col("LOGGED_AT").between(F.lit(began), F.lit(ended))
    sums = [F.count(F.lit(1)).alias("PERIODS"), F.sum("ROWS").alias("ROWS"), F.bool_and(within).alias("LOGGED_IN_RUN")]
    return audit.groupBy("OUTPUT", "STATUS", message).agg(*sums)


def _all_outputs(s: Session) -> DataFrame:
    """A full run over all six outputs: the columns and rows each typed table ends up with."""
    run = s.run(*OUTPUTS)
    _checked(run.execute())
    parts = []
    for name, table in run.tables.items():
        rows = s.spark.table(table)
        counted = rows.agg(F.count(F.lit(1)).alias("ROWS"))
        parts.append(
            counted.select(F.lit(name).alias("OUTPUT"), F.lit(len(rows.columns)).cast("long").alias("COLUMNS"), "ROWS")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _output_columns(s: Session) -> DataFrame:
    """A full run over the monthly outputs: place, name and type of every column of the tables, and how many values it has."""
    names = [name for name, output in OUTPUTS.items() if not output.daily]
    run = s.run(*names)
    _checked(run.execute())
    parts = []
    for name in names:
        rows = s.spark.table(run.tables[name])
        counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
        columns = [
            F.struct(
                F.lit(i).cast("long").alias("POSITION"),
                F.lit(f.name).alias("COLUMN"),
                F.lit(f.dataType.simpleString()).alias("TYPE"),
                F.col(f.name).alias("VALUES"),
            )
            for i, f in enumerate(rows.schema, 1)
        ]
        parts.append(counts.select(F.lit(name).alias("OUTPUT"), F.inline(F.array(*columns))))
    return reduce(DataFrame.unionByName, parts)


_CHANNEL = ["UPLOADER_TYPE", "PLATFORM", "MONTH", "CHANNEL_ID", "CHANNEL_NAME"]

_QUERIES: dict[str, Callable[[Session], DataFrame]] = {
    # scans
    "views_daily": lambda s: S.views_daily(s.basic),
    "revenue_daily": lambda s: S.revenue_daily(s.revenue),
    "region_views": lambda s: S.region_views(s.basic),
    "region_revenue": lambda s: S.region_revenue(s.revenue),
    "demo_views": lambda s: S.demo_views(s.basic),
    "demo_share": lambda s: S.demo_share(s.demographics),
    "traffic_views": lambda s: S.traffic_views(s.combined, s.dims.traffic_sources),
    "device_views": lambda s: S.device_views(s.combined, s.dims.devices),
    # columns
    "geo_bucket": lambda s: _views_by(s.basic, "COUNTRY_CODE", B.geo_bucket("COUNTRY_CODE").alias("GEO")),
    "device_bucket": lambda s: _views_by(
        S.device_views(s.combined, s.dims.devices),
        "DEVICE_TYPE_NAME",
        B.device_bucket("DEVICE_TYPE_NAME").alias("DEVICE_BUCKET"),
    ),
    "traffic_category": lambda s: _views_by(
        S.traffic_views(s.combined, s.dims.traffic_sources),
        "TRAFFIC_SOURCE_TYPE_NAME",
        B.traffic_category("TRAFFIC_SOURCE_TYPE_NAME").alias("TRAFFIC_SOURCE_TYPE_CATEGORY"),
    ),
    "region_flags": _region_flags,
    "title_series": lambda s: s.metadata.select(
        "VIDEO_ID", "VIDEO_TITLE", title_series("VIDEO_TITLE", sample_title_rules()).alias("DOMO_SERIES_NAME")
    ),
    "title_series_joined": lambda s: label_by_rules(
        s.metadata.select("VIDEO_ID", "VIDEO_TITLE"), "VIDEO_TITLE", _sample_rule_table(s), "DOMO_SERIES_NAME"
    ),
    "title_series_texts": lambda s: s.star.table("documents").select(
        "doc_id", title_series("text", DOCUMENT_RULES).alias("DOMO_SERIES_NAME")
    ),
    "title_series_rule_table": _rule_table,
    "video_form": lambda s: _video_key(
        D.map_video_title(s.months, s.metadata, form=True), "VIDEO_TITLE", "DURATION", "VIDEO_FORM"
    ),
    "program_id_extract": lambda s: s.metadata.select(
        "VIDEO_ID", "CUSTOM_ID", "THIRD_PARTY_VIDEO_ID", program_id().alias("EXTRACTED_PPL_ID")
    ),
    "calculated_cpm": lambda s: _video_key(
        s.months, "AD_IMPRESSIONS", "ESTIMATED_YOUTUBE_AD_REVENUE", "CALCULATED_CPM"
    ),
    "cpm_avg_of_avg": lambda s: _video_key(s.months, "ESTIMATED_CPM"),
    "date_key_functions": _date_keys,
    # joins and dimensions
    "views_revenue_full": lambda s: C.views_revenue_full(s.basic, s.revenue),
    "region_views_revenue": lambda s: C.region_views_revenue(s.basic, s.revenue),
    "map_video_title": lambda s: D.map_video_title(S.region_views(s.basic), s.metadata).drop(
        "PLATFORM", "WATCH_TIME_MINUTES"
    ),
    "latest_channel_name": lambda s: D.latest_channel_names(s.metadata),
    "map_channel_name": lambda s: _named_views(s).drop("PLATFORM", "WATCH_TIME_MINUTES", "BRAND_ROLL_UP"),
    "brand_rollup": lambda s: _views_by(_named_views(s), "CHANNEL_ID", "CHANNEL_NAME", "BRAND_ROLL_UP"),
    "brand_from_table": lambda s: D.map_brand_from_table(
        _views_by(_named_views(s), "CHANNEL_ID", "CHANNEL_NAME"), s.brand_map
    ),
    "repeated_videos": lambda s: D.repeated_videos(s.metadata),
    "repeated_dimension_keys": lambda s: D.repeated_keys(s.star.inputs()),
    "program_lookup": lambda s: D.repeated(s.dims.programs).drop("CUSTOM_ID", "THIRD_PARTY_VIDEO_ID"),
    "series_correction": lambda s: _video_key(
        D.map_series(s.months, s.dims.series_by_video), "VIEWS", "EXTRACTED_PPL_ID", "SERIES_ID", "SERIES_NAME"
    ),
    "parent_series": lambda s: _video_key(
        D.map_series(s.months, D.map_parent_series(s.dims.series_by_video, s.dims.parents), s.dims.parents),
        "VIEWS",
        "SERIES_ID",
        "PARENT_SERIES_ID",
        "PARENT_SERIES_NAME",
    ),
    # demographics
    "demo_join": lambda s: s.demo,
    "demo_join_geo": lambda s: C.demo_join(s.basic, s.demographics, match_geo=True),
    "demo_geo_sum": lambda s: demo_geo_sum(C.demo_join(s.basic, s.demographics, match_geo=True, keep_geo=True)),
    "window_total": lambda s: with_group_total(
        s.demo, ["UPLOADER_TYPE", "MONTH", "CHANNEL_ID"], "DEMO_VIEWS", "TOTAL_VIEWS"
    ).drop("PLATFORM", "UPLOADER_TYPE", "DEMO_WATCH_TIME_MINUTES"),
    "demo_profile": lambda s: demo_profile(s.demo_formed(), ["UPLOADER_TYPE", "MONTH"]),
    "demo_profile_channel": lambda s: demo_profile(s.demo_formed(), _CHANNEL),
    "demo_profile_form": lambda s: demo_profile(s.demo_formed(), [*_CHANNEL, "VIDEO_FORM"]),
    # marts
    "video_monthly": lambda s: M.video_mart(s.dims, "monthly"),
    "video_daily": lambda s: M.video_mart(s.dims, "daily"),
    "demographics_monthly": lambda s: M.demographics_mart(s.dims),
    "traffic_monthly": lambda s: M.traffic_mart(s.dims),
    "device_monthly": lambda s: M.device_mart(s.dims),
    "region_rollup": lambda s: M.region_mart(s.dims),
    # loading
    "month_bounds": lambda s: P.month_bounds(s.basic, "REPORTING_DATE", _loaded_until_march(s)),
    "day_bounds": lambda s: P.day_bounds(s.basic, "REPORTING_DATE", _loaded_until_march(s)),
    "month_calendar": lambda s: P.pending_months(s.basic, "REPORTING_DATE", _first_halves(s).limit(0)),
    "pending_months": lambda s: P.pending_months(s.basic, "REPORTING_DATE", _first_halves(s)),
    "output_schemas": _all_outputs,
    "sink_append": _sink_append,
    "sink_replace_month": _sink_replace_month,
    "sink_truncate_from": _sink_truncate_from,
    "incremental_month_load": _incremental,
    "reprocess_months": _reprocess,
    "run_audit": _audit,
    "refused_cases": _refused_cases,
    "latest_days": _latest_days,
    "output_columns": _output_columns,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the monthly video mart."""
    return queries()["video_monthly"](spark, "/root/testdata/sf0.001")


def _query(build: Callable[[Session], DataFrame], dense: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: portable(build(Session(spark, folder, dense)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = {name: _query(build) for name, build in _QUERIES.items()}
    return plain | {f"dense_{name}": _query(_QUERIES[name], dense=True) for name in ON_DENSE_FACTS} | _MORE


def oracle_sql() -> dict[str, str]:
    return ORACLES | _MORE_SQL
