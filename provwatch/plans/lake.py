"""The model graph, and the tables it leaves behind.

The folder is the state: a lake opened over it by another session finds the tables there. Full models are written
beside their last version and then become the current one; the version before is kept for readers that are still at
it. Incremental models keep their load mark with the table and merge source rows that are new since.

Each silver and gold table is written to Parquet once and read back by the models above it. That keeps
plans short, gives the optimizer real file sizes to choose joins by, and means that a lost executor costs
one model's tasks rather than the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from provwatch.plans.alerts import build_alerts
from provwatch.plans.exclusions import build_exclusions
from provwatch.plans.facilities import build_facilities
from provwatch.plans.hospital_spending import build_hospital_spending
from provwatch.plans.ml_features import build_ml_features
from provwatch.plans.payments import build_payments
from provwatch.plans.prescriptions import build_prescriptions
from provwatch.plans.provider import build_provider
from provwatch.plans.provider_360 import build_provider_360
from provwatch.plans.risk_score import build_risk_score
from provwatch.plans.summaries import build_payments_summary, build_prescriptions_summary
from provwatch.sources.bronze import stage
from provwatch.sources.schemas import LOAD_TIMESTAMP
from provwatch.sources.sinks import current_version, drop_old_versions, next_version, write_clustered, write_table
from provwatch.streaming.incremental import MergedTable, latest_part_d_rows


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    # Columns a clustered write sorts by, and the column that splits hot keys there.
    cluster_by: tuple[str, ...] = ()
    spread: tuple[str, ...] = ()
    # The key of an incremental model, how many of its inputs grow by loads (the first ones), and what is done to the
    # rows of a load before the model.
    key: str | None = None
    loads: int = 0
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows


# Sources by the role they play; registry sources keep active rows only where the flag says so.
ACTIVE_ONLY = {"nppes_provider", "taxonomy_code"}

MODELS: dict[str, Model] = {
    "excluded_providers": Model(build_exclusions, ("leie", "nppes_provider", "nppes_address")),
    "provider": Model(build_provider, ("nppes_provider", "nppes_address", "nppes_taxonomy", "leie")),
    "payments": Model(
        build_payments,
        ("open_payments_general", "open_payments_research", "open_payments_ownership", "leie"),
        ("STATE", "NPI", "PAYMENT_CATEGORY"),
        ("PAYMENT_ID",),
    ),
    "prescriptions": Model(
        build_prescriptions,
        ("part_d", "leie"),
        ("STATE", "NPI"),
        ("PRESCRIPTION_ID",),
        key="PRESCRIPTION_ID",
        loads=1,
        prepare=latest_part_d_rows,
    ),
    "facilities": Model(build_facilities, ("hospice", "home_health", "ltch", "nursing_home"), key="CCN", loads=4),
    "hospital_spending": Model(build_hospital_spending, ("spending",), key="SPENDING_ID", loads=1),
    "payments_summary": Model(build_payments_summary, ("payments",)),
    "prescriptions_summary": Model(build_prescriptions_summary, ("prescriptions",)),
    "provider_360": Model(
        build_provider_360, ("provider", "payments_summary", "prescriptions_summary", "excluded_providers")
    ),
    "fraud_risk_score": Model(build_risk_score, ("provider_360",)),
    "high_risk_alerts": Model(
        build_alerts,
        ("provider_360", "fraud_risk_score", "excluded_providers", "payments", "prescriptions"),
    ),
    "provider_ml_features": Model(build_ml_features, ("provider_360", "prescriptions", "payments")),
}


class Lake(Mapping[str, DataFrame]):
    """Model tables over one set of sources, kept in one folder and built on first use.

    ``sources`` maps source names to functions that return the landed DataFrame. ``incremental`` merges loads into the
    models that have a key, ``clustered`` orders full models by their cluster columns.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, Callable[[], DataFrame]],
        folder: str,
        clustered: bool = True,
        incremental: bool = True,
    ) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.clustered, self.incremental = clustered, incremental
        self._sources = sources

    def source(self, name: str) -> DataFrame:
        """Staged source; a view, never written."""
        return stage(self._sources[name](), active_only=name in ACTIVE_ONLY, stamped=False)

    def _input(self, name: str) -> DataFrame:
        return self[name] if name in MODELS else self.source(name)

    def plan(self, name: str) -> DataFrame:
        """The model itself, not yet run, over its written inputs."""
        model = MODELS[name]
        return model.build(*[self._input(i) for i in model.inputs])

    def _merged(self, name: str) -> MergedTable | None:
        """The table of an incremental model."""
        key = MODELS[name].key if self.incremental else None
        return MergedTable(self.spark, f"{self.folder}/{name}", key) if key else None

    def _merge(self, model: Model, table: MergedTable, full: bool) -> None:
        inputs = [self._input(i) for i in model.inputs]
        loads, others = inputs[: model.loads], inputs[model.loads :]
        marked = all(LOAD_TIMESTAMP in df.columns for df in loads)

        def build(*rows: DataFrame) -> DataFrame:
            return model.build(*map(model.prepare, rows), *others, keep_load_time=marked)

        if full:
            table.replace(build(*loads))
        elif marked:
            table.refresh(loads, build)
        else:  # loads without a time: all rows are compared
            table.merge(build(*loads))

    def refresh(self, name: str, full: bool = False) -> None:
        """Bring one model up to date with its inputs as they are: by new loads if it is incremental, else anew.

        ``full`` also builds an incremental model anew: rows of earlier loads then follow a changed other input.
        """
        model, path = MODELS[name], f"{self.folder}/{name}"
        table = self._merged(name)
        if table is not None:
            self._merge(model, table, full)
            return
        target, plan = next_version(self.spark, path), self.plan(name)
        if self.clustered and model.cluster_by:
            write_clustered(plan, target, model.cluster_by, spread=model.spread)
        else:
            write_table(plan, target)
        drop_old_versions(self.spark, path)

    def _open(self, name: str) -> DataFrame | None:
        table = self._merged(name)
        if table is not None:
            return table.read() if table.exists() else None
        path = current_version(self.spark, f"{self.folder}/{name}")
        return None if path is None else self.spark.read.parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        """The table as it was last built, by whatever session; built now if it never was."""
        found = self._open(name)
        if found is None:
            self.refresh(name)
            found = self._open(name)
        return found

    def __iter__(self) -> Iterator[str]:
        return iter(MODELS)

    def __len__(self) -> int:
        return len(MODELS)

    def build_all(self, full: bool = False) -> dict[str, DataFrame]:
        """Refresh every model, in dependency order."""
        for name in MODELS:
            self.refresh(name, full)
        return {name: self[name] for name in MODELS}
