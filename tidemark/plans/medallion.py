"""The medallion run of one domain: bronze -> gold -> metrics, table by table.

Every stage writes its table and the next stage reads the written rows, so a
lost executor repeats one stage's tasks at most and nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.cdc import current_state
from tidemark.operators.semantic import MetricView
from tidemark.plans.domains import DomainSpec
from tidemark.plans.gates import gold_gate
from tidemark.sources.files import CHANGE_TYPE, select_contract
from tidemark.sources.sinks import materialize


@dataclass(frozen=True)
class MedallionRun:
    """The written tables of a run, by stage, and its gold gate."""

    tables: Mapping[str, DataFrame]
    gate: DataFrame

    def metrics(self, view: MetricView, source: str, dimensions, measures) -> DataFrame:
        """A metric query with one of the run's tables as the view's source."""
        return view.query({view.source: self.tables[source]}, dimensions, measures)


def run_domain(spark: SparkSession, spec: DomainSpec, root: str,
               read_transactions: Callable[[], DataFrame],
               read_documents: Callable[[], DataFrame]) -> MedallionRun:
    """Run a domain's stages in order.

    Transactions may be a plain snapshot or a change log; a change log is
    reduced to its current state first. Either way bronze is the same table.
    """
    raw = read_transactions()
    if CHANGE_TYPE in raw.columns:
        raw = current_state(raw, spec.source_key)
    bronze = materialize(select_contract(raw, raw.columns), f"{root}/bronze_transactions")
    documents = materialize(read_documents(), f"{root}/silver_documents")
    detail = materialize(spec.detail(bronze, documents), f"{root}/gold_detail")
    mart = materialize(spec.mart_of(detail), f"{root}/gold_mart")
    return MedallionRun(
        {"bronze_transactions": bronze, "silver_documents": documents,
         "gold_detail": detail, "gold_mart": mart},
        gold_gate(spec, bronze, documents, detail, mart))


