"""The prepared dimensions of a run, built on first use and shared by all marts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame

from reelmart.operators import dimensions as D
from reelmart.operators.lookups import Lookup, lookup
from reelmart.session import materialized, remove
from reelmart.sources.inputs import Inputs


class Dimensions:
    """Conformed dimensions over one set of inputs.

    With ``keep=True`` the derived ones are computed once and written to the shared folder, so
    that six marts do not classify the metadata six times; ``release`` removes them. Without it they stay lazy.
    """

    def __init__(self, inputs: Inputs, title_rules: Iterable[D.TitleClause], keep: bool = False):
        self.inputs = inputs
        self.title_rules = list(title_rules)
        self.keep = keep
        self.folders: list[str] = []

    def _kept(self, df: DataFrame) -> DataFrame:
        if not self.keep:
            return df
        df, folder = materialized(df)
        self.folders.append(folder)
        return df

    def release(self) -> None:
        """Remove what was written; the dimensions can't be used afterwards."""
        while self.folders:
            remove(self.inputs.metadata.sparkSession, self.folders.pop())

    @cached_property
    def forms(self) -> DataFrame:
        return self._kept(D.video_forms(self.inputs.metadata))

    @cached_property
    def programs(self) -> DataFrame:
        program = lookup(D.program_table(self.inputs.program), "PROGRAM_ID")
        return D.video_programs(D.metadata_rows(self.inputs.metadata), program, self.title_rules)

    @cached_property
    def series_by_video(self) -> DataFrame:
        corrected = lookup(D.corrected_table(self.inputs.corrected_series), "DOMO_SERIES_NAME")
        return D.corrected_series(self.programs, corrected)

    @cached_property
    def series_and_parents(self) -> DataFrame:
        """The series of the videos with their parents, found among metadata rows and not for each fact."""
        return self._kept(D.map_parent_series(self.series_by_video, self.parents))

    @cached_property
    def series_copies(self) -> DataFrame:
        return D.series_copies(self.series_and_parents)

    @cached_property
    def channels(self) -> Lookup:
        return lookup(self._kept(D.channels(self.inputs.metadata)), "CHANNEL_ID")

    @cached_property
    def parents(self) -> Lookup:
        table = D.parent_series(D.program_table(self.inputs.program), self.inputs.series)
        return lookup(self._kept(table), "SERIES_ID")

    @cached_property
    def countries(self) -> Lookup:
        return lookup(self.inputs.country_info, "COUNTRY_CODE")

    @cached_property
    def traffic_sources(self) -> Lookup:
        return lookup(self.inputs.traffic_dim, "TRAFFIC_SOURCE_TYPE_ID")

    @cached_property
    def devices(self) -> Lookup:
        return lookup(self.inputs.device_dim, "DEVICE_TYPE")
