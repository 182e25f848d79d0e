"""Audit-log analysis over nested access records (struct and map fields)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Job and pipeline actions of interest in the audit log.
PIPELINE_SERVICES = ("jobs", "pipelines", "lakeflow")
PIPELINE_ACTIONS = ("runStart", "runSucceeded", "runFailed", "runNow", "pipelineStarted", "pipelineStopped",
                    "pipelineCompleted", "createPipeline", "updatePipeline", "deletePipeline", "createJob",
                    "updateJob", "deleteJob", "runJobNow")


def param(name: str) -> Column:
    """A request parameter; a missing key is NULL."""
    return F.element_at(F.col("request_params"), F.lit(name))


def _since(now: Column, days: int) -> Column:
    return F.col("event_time") >= now - F.make_dt_interval(days=F.lit(days))


def _on_catalog(catalog: str) -> Column:
    return (F.lower(param("catalog_name")) == F.lower(F.lit(catalog))) | \
        F.lower(param("full_name_arg")).like(f"{catalog.lower()}.%")


def audit_recent(log: DataFrame, now: Column, days: int, catalog: str, n: int = 100) -> DataFrame:
    """Recent activity on a catalog, newest first."""
    return (log.where(_since(now, days) & _on_catalog(catalog))
            .select("event_id", F.to_date("event_time").alias("event_date"), "event_time", F.col("user_identity.email").alias("user_or_principal"),
                    "action_name", param("catalog_name").alias("catalog_name"),
                    param("schema_name").alias("schema_name"), param("table_name").alias("table_name"),
                    F.col("response.status_code").alias("status_code"), "source_ip_address")
            .orderBy(F.desc("event_time"), F.desc("event_id")).limit(n))


def audit_object(log: DataFrame, now: Column, days: int, catalog: str, schema: str, table: str,
                 n: int = 50) -> DataFrame:
    """Who created or changed one table (by parts, or by full name), with the map of all its request parameters."""
    by_parts = (F.lower(param("catalog_name")) == catalog.lower()) & (F.lower(param("schema_name")) == schema.lower()) \
        & (F.lower(param("table_name")) == table.lower())
    by_name = F.lower(param("full_name_arg")) == f"{catalog}.{schema}.{table}".lower()
    return (log.where(_since(now, days) & (by_parts | by_name))
            .select("event_id", F.to_date("event_time").alias("event_date"), "event_time", F.col("user_identity.email").alias("user_or_principal"),
                    "action_name", param("catalog_name").alias("catalog_name"),
                    param("schema_name").alias("schema_name"), param("table_name").alias("table_name"),
                    param("full_name_arg").alias("full_name_arg"), F.col("response.status_code").alias("status_code"),
                    F.col("request_params").alias("raw_request_params"))
            .orderBy(F.desc("event_time"), F.desc("event_id")).limit(n))


def audit_pipeline_events(log: DataFrame, now: Column, days: int, n: int = 100) -> DataFrame:
    """Job and pipeline run events."""
    cond = F.col("service_name").isin(*PIPELINE_SERVICES) | F.col("action_name").isin(*PIPELINE_ACTIONS)
    return (log.where(_since(now, days) & cond)
            .select("event_id", F.to_date("event_time").alias("event_date"), "event_time", F.col("user_identity.email").alias("user_or_principal"),
                    "action_name", "service_name", param("job_id").alias("job_id"), param("run_id").alias("run_id"),
                    param("pipeline_id").alias("pipeline_id"), F.col("response.status_code").alias("status_code"))
            .orderBy(F.desc("event_time"), F.desc("event_id")).limit(n))


def audit_summary(log: DataFrame, now: Column, days: int, catalog: str, n: int = 50) -> DataFrame:
    """Events per (principal, action, status) with first and last time, busiest first."""
    return (log.where(_since(now, days) & _on_catalog(catalog))
            .groupBy(F.col("user_identity.email").alias("user_or_principal"), "action_name",
                     F.col("response.status_code").alias("status_code"))
            .agg(F.count(F.lit(1)).alias("event_count"), F.min("event_time").alias("first_seen"),
                 F.max("event_time").alias("last_seen"))
            .orderBy(F.desc("event_count"), "user_or_principal", "action_name", "status_code").limit(n))
