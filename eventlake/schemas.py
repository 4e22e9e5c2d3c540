"""Declared schemas, as DDL. Leaves of the raw events are strings: an odd value is cast later and doesn't fail a read."""

RAW = "id string, type string, created_at string, public string, actor struct<login:string>, repo struct<id:string,name:string>, org struct<login:string>, payload string"

SILVER = {
    "id": "string",
    "type": "string",
    "created_at": "timestamp_ntz",
    "public": "boolean",
    "actor_login": "string",
    "repo_id": "bigint",
    "repo_name": "string",
    "org_login": "string",
    "payload_action": "string",
    "pr_number": "bigint",
    "pr_merged_at": "timestamp_ntz",
    "push_commits": "int",
}
SILVER_DDL = ", ".join(f"{name} {kind}" for name, kind in SILVER.items())

METRICS = (
    "kind string, hour string, recorded_at string, duration_seconds double, rows_in bigint, rows_out bigint, bytes_out bigint, "
    "bytes_downloaded bigint, rows bigint, soft_warnings bigint, skipped boolean"
)

MARTS = ("event_type_daily", "repo_activity_daily", "trending_repos", "pr_stats_daily")
