"""Scanner findings, users, roles and privileges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions import sections as S
from sparkgauge.functions.text import hash_email
from sparkgauge.operators.aggregates import direct_roles
from sparkgauge.operators.expand import flatten_outer_if
from sparkgauge.operators.graph import privilege_closure, role_closure
from sparkgauge.operators.joins import last_success_per_user, latest_per_key
from sparkgauge.operators.predicates import not_deleted
from sparkgauge.operators.state import snapshot_diff
from sparkgauge.plans.collectors.spec import RowSpec, at, instrument

# Members of a finding row and the columns they come from.
_FINDING_DIMENSIONS = {
    "event.category": "CASE WHEN severity = 'LOW' THEN 'Warning' ELSE 'Vulnerability management' END",
    "vulnerability.risk.level": "coalesce(severity, 'NONE')",
    "platform.trust_center.scanner.id": "scanner_id",
    "platform.trust_center.scanner.type": "scanner_type",
    "platform.trust_center.scanner.package.id": "scanner_package_id",
}
FINDINGS = RowSpec(
    timestamp="created_on",
    start="start_timestamp",
    end="end_timestamp",
    message="'[' || severity || '] ' || scanner_name || ' ' || scanner_short_description",
    status="CASE WHEN completion_status = 'SUCCEEDED' THEN 'OK' WHEN length(coalesce(completion_status, '')) > 0 THEN 'ERROR' ELSE 'UNSET' END",
    dimensions=_FINDING_DIMENSIONS,
    attributes={
        "status.message": "'[' || severity || '] ' || scanner_name || ' ' || scanner_short_description",
        "error.code": "scanner_id",
        "event.id": "event_id",
        "event.kind": "'SECURITY_EVENT'",
        "platform.trust_center.scanner.name": "scanner_name",
        "platform.trust_center.scanner.description": "scanner_short_description",
        "platform.trust_center.scanner.package.name": "scanner_package_name",
        "platform.entity.id": "entity_id",
        "platform.entity.name": "entity_name",
        "platform.entity.type": "entity_type",
        "platform.entity.details": "entity_details",
    },
)
FINDING_METRICS = RowSpec(
    timestamp="run_at",
    message="'Findings of ' || scanner_id",
    dimensions=_FINDING_DIMENSIONS,
    metrics={"platform.trust_center.findings": "total_at_risk_count"},
)
# Members of a user row and the columns they come from.
USERS = RowSpec(
    timestamp="run_at",
    message="'User details for ' || login_name",
    dimensions={"db.user": "login_name"},
    attributes={
        "platform.user.id": "user_id",
        "platform.user.display_name": "display_name",
        "platform.user.name": "name",
        "platform.user.name.first": "first_name",
        "platform.user.name.last": "last_name",
        "platform.user.email": "reported_email",
        "platform.user.must_change_password": "must_change_password",
        "platform.user.has_password": "has_password",
        "platform.user.comment": "comment",
        "platform.user.is_disabled": "disabled",
        "platform.user.is_locked": "locked",
        "platform.user.is_from_organization": "is_from_organization_user",
        "platform.user.default.warehouse": "default_warehouse",
        "platform.user.default.namespace": "default_namespace",
        "platform.user.default.role": "default_role",
        "platform.user.ext_authn.duo": "ext_authn_duo",
        "platform.user.ext_authn.uid": "ext_authn_uid",
        "platform.user.has_rsa": "has_rsa_public_key",
        "platform.user.has_mfa": "has_mfa",
        "platform.user.has_pat": "has_pat",
        "platform.user.has_workload_identity": "has_workload_identity",
        "platform.user.owner": "owner",
        "platform.user.default.secondary_role": "default_secondary_role",
        "platform.user.type": "type",
        "platform.user.expires_at": "ns:expires_at",
        "platform.user.locked_until_time": "ns:locked_until_time",
        "platform.user.bypass_mfa_until": "ns:bypass_mfa_until",
    },
    event_times={
        "platform.user.created_on": "created_on",
        "platform.user.last_success_login": "last_success_login",
        "platform.user.deleted_on": "deleted_on",
        "platform.user.password_last_set_time": "password_last_set_time",
    },
)

ENTITY_SCHEMA = "array<struct<entity_id:string,entity_name:string,entity_object_type:string,entity_detail:string,entity_details:string>>"


def trust_center(findings: DataFrame, *, log_details: bool = False) -> DataFrame:
    """Latest findings per scanner with log level; with details, one row per entity at risk."""
    latest = latest_per_key(findings, "scanner_id", "start_timestamp")
    opened = latest.withColumn("at_risk_entities", F.from_json("at_risk_entities", ENTITY_SCHEMA))
    rows = flatten_outer_if(opened, "at_risk_entities", "_entity", log_details).withColumns(
        {
            "entity_id": F.col("_entity.entity_id"),
            "entity_name": F.col("_entity.entity_name"),
            "entity_type": F.col("_entity.entity_object_type"),
            "entity_details": F.coalesce("_entity.entity_detail", "_entity.entity_details"),
        }
    )
    out = instrument(rows, FINDINGS, ["event_id", "severity"])
    return out.withColumn("level", S.severity_level(F.col("severity")))


def trust_center_metrics(findings: DataFrame, as_of: dt.datetime) -> DataFrame:
    latest = latest_per_key(findings, "scanner_id", "start_timestamp")
    return instrument(latest.withColumn("run_at", at(as_of)), FINDING_METRICS, ["event_id"])


def users(
    accounts: DataFrame, seen: DataFrame, logins: DataFrame, as_of: dt.datetime, mark: dt.datetime, *, is_hashed: bool = True
) -> DataFrame:
    """Users new or changed since earlier snapshots, with hashed mail and last login.

    Last login is attached after the comparison, so that a login alone is no change.
    """
    snapshot = not_deleted(accounts, "deleted_on", mark)
    changed = snapshot_diff(snapshot.select(*seen.columns), seen, mark, as_of)
    full = snapshot.join(changed.select("user_id").distinct(), "user_id", "left_semi")
    rows = last_success_per_user(full, logins).withColumns({"run_at": at(as_of), "reported_email": hash_email(F.col("email"), is_hashed)})
    return instrument(rows, USERS, ["user_id"])


def _role_rows(rows: DataFrame, as_of, attributes: dict, times: dict, message=None) -> DataFrame:
    return rows.select(
        S.epoch_nanos(at(as_of)).alias("timestamp_ns"),
        S.epoch_nanos(at(as_of)).alias("start_time"),
        (F.lit(None).cast("string") if message is None else message).alias("message"),
        S.text_section({"db.user": F.col("user_name")}).alias("dimensions"),
        S.text_section(attributes).alias("attributes"),
        F.create_map().cast(S.NUMBER_MAP).alias("metrics"),
        S.time_section(times).alias("event_timestamps"),
    )


def users_direct_roles(grants: DataFrame, as_of: dt.datetime, mark: dt.datetime) -> DataFrame:
    """Direct roles per user: all on the first run of a day, later only newly granted ones."""
    rows = direct_roles(grants, mark, first_of_day=mark.date() != as_of.date())
    return _role_rows(
        rows,
        as_of,
        {"platform.user.roles.direct": F.to_json("roles"), "platform.user.roles.granted_by": F.to_json("granted_by")},
        {"platform.user.roles.last_altered": F.col("last_altered")},
    )


def users_removed_direct_roles(grants: DataFrame, as_of: dt.datetime, mark: dt.datetime) -> DataFrame:
    """Roles taken from a user, per hour, since the mark."""
    gone = grants.filter(F.col("deleted_on") > F.lit(mark))
    hour = F.date_trunc("hour", "deleted_on")
    counted = gone.groupBy("user_name", hour.alias("hour"), "role").agg(F.count("*").cast("int").alias("n"))
    parts = F.flatten(F.collect_list(F.array_repeat("role", F.col("n"))))
    rows = counted.groupBy("user_name", "hour").agg(F.array_join(F.array_sort(parts), "").alias("roles"))
    return _role_rows(
        rows,
        as_of,
        {"platform.user.roles.direct.removed": F.col("roles")},
        {"platform.user.roles.direct.removed_on": F.col("hour")},
        F.lit(f"User direct roles removed since {mark.isoformat(sep=' ')}"),
    )


def _by_grant(grants: DataFrame, reach: DataFrame) -> DataFrame:
    """Reach of every role, looked up from the live grants of users."""
    live = grants.filter(F.col("deleted_on").isNull()).select("user_name", "role", "granted_by", "created_on")
    return live.join(reach.withColumnRenamed("parent", "role"), "role", "left")


def users_all_roles(grants: DataFrame, edges: DataFrame, roles: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Effective roles per user: the closure is computed once per role, not per user."""
    reach = role_closure(edges, roles).select("parent", "child")
    rows = _by_grant(grants, reach).groupBy("user_name").agg(
        F.array_join(F.array_sort(F.collect_set("child")), ",").alias("roles"),
        F.array_sort(F.collect_set("granted_by")).alias("granted_by"),
        F.max("created_on").alias("last_altered"),
    )
    return _role_rows(
        rows,
        as_of,
        {"platform.user.roles.all": F.col("roles"), "platform.user.roles.granted_by": F.to_json("granted_by")},
        {"platform.user.roles.last_altered": F.col("last_altered")},
    )


def users_all_privileges(grants: DataFrame, edges: DataFrame, roles: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Effective privileges per user and (privilege, object type) with the objects they are on."""
    reach = privilege_closure(edges, roles).select("parent", "privilege", "granted_on", "child")
    rows = _by_grant(grants, reach).groupBy("user_name", "privilege", "granted_on").agg(
        F.array_join(F.array_sort(F.collect_set("child")), ",").alias("grants_on"),
        F.array_sort(F.collect_set("granted_by")).alias("granted_by"),
        F.max("created_on").alias("last_altered"),
    )
    return _role_rows(
        rows,
        as_of,
        {
            "platform.user.privilege": F.concat("privilege", F.lit(":"), "granted_on"),
            "platform.user.privilege.grants_on": F.col("grants_on"),
            "platform.user.privilege.granted_by": F.to_json("granted_by"),
        },
        {"platform.user.privilege.last_altered": F.col("last_altered")},
    )
