"""The claims attribution run: cohort, monthly table, organisations, split, enrichment, reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from claimtree.operators import claims as ops
from claimtree.plans.stages import StageStore
from claimtree.session import scratch_path
from claimtree.sources.sinks import export_csv, materialize, save_table


@dataclass(frozen=True)
class ClaimSources:
    """The input tables of a run. ``slices`` are the physical claim tables, one or more."""

    slices: Sequence[DataFrame]
    drug: DataFrame
    plan: DataFrame
    physician: DataFrame
    affiliation: DataFrame
    hospital: DataFrame
    physician_group: DataFrame
    plan_channel: DataFrame
    entity_type: DataFrame
    ndc_map: DataFrame | None = None
    product_class: DataFrame | None = None


@dataclass(frozen=True)
class Cohort:
    """Which claims to follow: drug name patterns, or therapy areas (``area`` narrows them to one)."""

    patterns: Sequence[str] = ()
    areas: Sequence[str] = ()
    area: str | None = None


# The stage tables in order.
STAGES = [
    "cohort", "monthly", "by_npi", "by_org", "split", "attributed", "yearly", "crosstab", "plan_mix", "drug_ranking",
]
# Stages of few rows whatever the number of claims.
REPORTS = frozenset(["crosstab", "plan_mix", "drug_ranking"])


@dataclass
class ClaimRun:
    """Stage tables of a run, each made when asked for.

    The stages that others reuse are written once, to ``workdir`` or else under the session's scratch
    folder, and read back, so that several results of a run scan the claims once. With ``inputs``, the state of
    the source files (see ``stages.input_state``), a run in the same ``workdir`` takes over the stages that an
    earlier one has finished. Area cohorts keep claims without a drug row, name cohorts drop them.
    ``exact_cents`` keeps pays as integer cents.
    """

    src: ClaimSources
    selection: Cohort
    year: int
    workdir: str | None = None
    exact_cents: bool = False
    top: int = 200
    inputs: str | None = None

    def __post_init__(self) -> None:
        if self.inputs is not None and not self.workdir:
            raise ValueError("stages can be taken over only in a workdir")

    def _stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        spark = self.src.drug.sparkSession
        if self.inputs is None:
            path = f"{self.workdir.rstrip('/')}/{name}" if self.workdir else scratch_path(spark, name)
            return materialize(build(), path)
        how = {"cohort": asdict(self.selection), "exact_cents": self.exact_cents, "classes": self.src.product_class is not None}
        return StageStore(spark, self.workdir, self.inputs, how).stage(name, build)

    @cached_property
    def cohort(self) -> DataFrame:
        """The slices are united before the join, so the drug side is prepared once."""
        return self._stage("cohort", self._cohort)

    def _cohort(self) -> DataFrame:
        rows = ops.cohort_union(*self.src.slices)
        if self.selection.areas:
            return ops.cohort_by_area(rows, self.src.drug, self.src.ndc_map, self.selection.areas)
        return ops.cohort_by_name(rows, self.src.drug, self.selection.patterns)

    @cached_property
    def monthly(self) -> DataFrame:
        return self._stage("monthly", self._monthly)

    def _monthly(self) -> DataFrame:
        how = "left" if self.selection.areas else "inner"
        rows = ops.monthly_physician_plan(self.cohort, self.src.drug, how, self.selection.area, self.exact_cents)
        if self.src.product_class is not None:
            rows = ops.enrich_class(rows, self.src.product_class)
        return rows

    @cached_property
    def by_npi(self) -> DataFrame:
        src = self.src
        profile = ops.affiliation_profile(src.affiliation, src.hospital, src.physician_group)
        rows = ops.enrich_physician(ops.enrich_plan(self.monthly, src.plan), src.physician)
        return ops.claims_by_npi(ops.enrich_affiliation(rows, profile))

    @cached_property
    def by_org(self) -> DataFrame:
        src = self.src
        dims = (src.plan, src.physician, src.affiliation, src.hospital, src.physician_group)
        return self._stage("by_org", lambda: ops.org_claims(self.monthly, *dims))

    @cached_property
    def split(self) -> DataFrame:
        return ops.claims_split(self.by_org)

    @cached_property
    def attributed(self) -> DataFrame:
        """The last large table; it is not written here, as it is a result itself."""
        return ops.enrich_entity(ops.enrich_channel(self.split, self.src.plan_channel), self.src.entity_type)

    @cached_property
    def _reported(self) -> DataFrame:
        return self._stage("attributed", lambda: self.attributed)

    @cached_property
    def yearly(self) -> DataFrame:
        return ops.rollup_year(self._reported, self.year)

    @cached_property
    def crosstab(self) -> DataFrame:
        return ops.facility_plan_crosstab(self._reported)

    @cached_property
    def plan_mix(self) -> DataFrame:
        return ops.plan_mix(ops.claims_per_plan(self.cohort), self.src.plan)

    @cached_property
    def drug_ranking(self) -> DataFrame:
        return ops.drug_ranking(self.cohort, self.src.drug, self.top)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in STAGES]


def publish(
    run: ClaimRun, tables: dict[str, tuple[str, str]], exports: dict[str, str], files: dict[str, int | None] | None = None,
) -> None:
    """Save stages as external tables (``stage -> (name, path)``) and as CSV files (``stage -> path``).

    ``files`` gives the number of CSV files of a stage. Others are one file for a report, and for stages that grow
    with the claims as many as the plan has tasks.
    """
    for stage, (name, path) in tables.items():
        save_table(getattr(run, stage), name, path)
    for stage, path in exports.items():
        export_csv(getattr(run, stage), path, (files or {}).get(stage, 1 if stage in REPORTS else None))
