"""ITSM queries: ticket detail, service mart and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import portable
from tidemark.plans import metrics, standins
from tidemark.plans.domains import domain_spec
from tidemark.plans.gates import gold_gate
from tidemark.workload import base
from tidemark.workload.finance import report, written_gold
from tidemark.workload.registry import register


def service_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_spec("itsm").mart_direct(
        standins.service_tickets(spark, sf_dir), standins.incident_reports(spark, sf_dir))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_spec("itsm").detail(
        standins.service_tickets(spark, sf_dir), standins.incident_reports(spark, sf_dir))


@register("mart_service_performance", base.with_ctes(
    "SELECT * FROM service_mart", base.TICKETS, base.REPORTS, base.SERVICE_MART))
def mart_service_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(service_mart(spark, sf_dir))


@register("gold_detail_incidents", base.with_ctes(
    """SELECT t.ticket_id, t.incident_id, t.priority, t.status, t.assignment_group, t.service,
  t.configuration_item, t.opened_at, t.resolved_at,
  CAST(t.resolution_hours AS DOUBLE) AS resolution_hours, t.sla_breached,
  r.incident_id AS report_incident_id, r.path AS incident_document_path,
  r.impact AS documented_impact
FROM tickets t LEFT JOIN reports r ON t.incident_id = r.incident_id""",
    base.TICKETS, base.REPORTS))
def gold_detail_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(incidents(spark, sf_dir))


@register("ticket_times", base.with_ctes(
    """SELECT ticket_id, opened_at, resolved_at,
  CAST(date_diff('day', CAST(opened_at AS DATE), CAST(resolved_at AS DATE)) AS BIGINT) AS open_days
FROM tickets""", base.TICKETS))
def ticket_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times kept as text are parsed explicitly; an unresolved ticket stays NULL."""
    opened, resolved = F.to_date("opened_at"), F.to_date("resolved_at")
    return portable(standins.service_tickets(spark, sf_dir).select(
        "ticket_id", "opened_at", "resolved_at", F.datediff(resolved, opened).alias("open_days")))


@register("gate_gold_incidents", base.gold_gate_sql(
    ",".join([base.TICKETS, base.REPORTS, base.SERVICE_MART]), "tickets", "reports",
    "service_mart", "ticket_id", "incident_id", "incident_id", {}))
def gate_gold_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = domain_spec("itsm")
    return gold_gate(spec, *written_gold(
        spark, spec, standins.service_tickets(spark, sf_dir),
        standins.incident_reports(spark, sf_dir), "gold-incidents"))


# -- metric views ----------------------------------------------------------------
_SUMS = {
    "incident_volume": "COUNT(*)",
    "mttr_hours": "CAST(SUM(resolution_hours) AS DOUBLE) / NULLIF(COUNT(resolution_hours), 0)",
    "sla_breach_count": "CAST(SUM(CASE WHEN sla_breached THEN 1 ELSE 0 END) AS BIGINT)",
}


def _incident_query(name: str, dims: list[str], measures: list[str], where: dict | None = None,
                    order_by: list[tuple[str, str]] = (), limit: int | None = None) -> None:
    snakes = [d.lower().replace(" ", "_") for d in dims]
    shown = snakes + [f"{_SUMS[m.lower().replace(' ', '_')]} AS {m.lower().replace(' ', '_')}"
                      for m in measures]
    sql = f"SELECT {', '.join(shown)} FROM tickets"
    if where:
        sql += " WHERE " + " AND ".join(
            f"{d.lower().replace(' ', '_')} = '{v}'" for d, v in where.items())
    sql += f" GROUP BY {', '.join(snakes)}"
    if order_by:
        sql += " ORDER BY " + ", ".join(
            f"{n.lower().replace(' ', '_')} {way.upper()}" for n, way in order_by)
    if limit is not None:
        sql += f" LIMIT {limit}"

    @register(name, base.with_ctes(sql, base.TICKETS))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(metrics.INCIDENTS.query(
            {"incidents": standins.service_tickets(spark, sf_dir)}, dims, measures, where,
            order_by, limit))


_incident_query("metric_incidents_all", ["Priority", "Service", "Assignment Group"],
                ["Incident Volume", "MTTR Hours", "SLA Breach Count"])
_incident_query("q_mttr_service", ["Service"], ["MTTR Hours"], None,
                [("MTTR Hours", "desc"), ("Service", "asc")])
_incident_query("q_volume_priority", ["Priority"], ["Incident Volume"], None,
                [("Incident Volume", "desc"), ("Priority", "asc")])
_incident_query("q_top_sla_group", ["Assignment Group"], ["SLA Breach Count"], None,
                [("SLA Breach Count", "desc"), ("Assignment Group", "asc")], 1)
_incident_query("q_top_p1_service", ["Service"], ["Incident Volume"], {"Priority": "P1"},
                [("Incident Volume", "desc"), ("Service", "asc")], 1)


@register("q_ci_by_service", base.with_ctes(
    """SELECT service, COUNT(DISTINCT configuration_item) AS affected_items
FROM tickets GROUP BY service ORDER BY service""", base.TICKETS))
def q_ci_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No view has this measure: a distinct count over the detail."""
    return (standins.service_tickets(spark, sf_dir).groupBy("service")
            .agg(F.count_distinct("configuration_item").alias("affected_items")).orderBy("service"))


@register("metric_services_all", base.with_ctes(
    """SELECT service, priority, CAST(SUM(incident_count) AS BIGINT) AS incident_volume,
  ROUND(AVG(mttr_hours), 6) AS mttr_hours,
  CAST(SUM(sla_breach_count) AS BIGINT) AS sla_breach_count
FROM service_mart GROUP BY service, priority""", base.TICKETS, base.REPORTS, base.SERVICE_MART))
def metric_services_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTTR here is a mean of per-incident means, as the view defines it."""
    return report(metrics.SERVICES.query(
        {"service_performance": service_mart(spark, sf_dir)}, ["Service", "Priority"],
        ["Incident Volume", "MTTR Hours", "SLA Breach Count"])
        .withColumn("MTTR Hours", F.round(F.col("`MTTR Hours`"), 6)))
