"""Schemas and names shared by every layer."""

from __future__ import annotations

_ACCOUNT = (
    "struct<id:bigint,login:string,display_login:string,"
    "avatar_url:string,gravatar_id:string,url:string>"
)

CORRUPT = "_corrupt_record"

# The payload is a variant: its shape depends on the event type, so nothing is gained
# from a union struct, and a day without some field keeps the same schema. It is parsed
# when the line is read, and never again.
LINE_COLUMNS = (
    f"id string, type string, actor {_ACCOUNT}, "
    f"repo struct<id:bigint,name:string,url:string>, org {_ACCOUNT}, "
    "public boolean, created_at string"
)
RAW_SCHEMA = f"{LINE_COLUMNS}, payload variant, {CORRUPT} string"

# What a line holds beside these fields is kept as JSON in this column.
REST = "rest"
KNOWN_FIELDS = {
    "event": ("id", "type", "actor", "repo", "org", "public", "created_at", "payload"),
    "actor": ("id", "login", "display_login", "avatar_url", "gravatar_id", "url"),
    "repo": ("id", "name", "url"),
    "org": ("id", "login", "display_login", "avatar_url", "gravatar_id", "url"),
}

BRONZE_SCHEMA = RAW_SCHEMA.removesuffix(f", {CORRUPT} string") + f", {REST} string, event_date date"

LABELS_TYPE = "array<struct<name:string,color:string>>"

SILVER_COLUMNS = (
    "event_id",
    "type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "org_login",
    "public",
    "created_at",
    "event_date",
    "pr_label_name",
    "pr_label_color",
)

EVENT_COLUMNS = SILVER_COLUMNS[:-2]

EVENT_SCHEMA = (
    "event_id string, type string, actor_id bigint, actor_login string, repo_id bigint, "
    "repo_name string, org_login string, public boolean, created_at timestamp_ntz, "
    "event_date date"
)
LABEL_SCHEMA = "event_id string, event_date date, pr_label_name string, pr_label_color string"
SILVER_SCHEMA = f"{EVENT_SCHEMA}, pr_label_name string, pr_label_color string"

# Event type names, list lengths and payload field names.
PULL_REQUEST = "PullRequestEvent"
WATCH = "WatchEvent"
PUSH = "PushEvent"
BOT_SUFFIX = "[bot]"
TOP_N = 20
FINDINGS_N = 10
PAYLOAD_FIELDS = (
    "action", "assignee", "assignees", "before", "comment", "description",
    "discussion", "forkee", "full_ref", "head", "issue", "label", "labels",
    "master_branch", "member", "number", "pages", "pull_request", "push_id",
    "pusher_type", "ref", "ref_type", "release", "repository_id", "review",
)
PAYLOAD_ARRAYS = ("assignees", "labels", "pages")
PUSH_CANDIDATES = (
    "push_id", "ref", "commits", "size", "distinct_size", "before", "head",
    "repository_id",
)
