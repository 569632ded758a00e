"""Paths into the JSON that model services and the web archive answer with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLY_PATHS = {
    "openai": "$.choices[0].message.content",
    "lmstudio": "$.choices[0].message.content",
    "ollama": "$.message.content",
    "claude": "$.content[0].text",
    "gemini": "$.candidates[0].content.parts[0].text",
}


def reply_text(body: Column, provider: str) -> Column:
    return F.get_json_object(body, REPLY_PATHS[provider])


def error_text(body: Column) -> Column:
    return F.get_json_object(body, "$.error.message")


def snapshot_url(body: Column) -> Column:
    """The closest archived snapshot that is available, asked for without the archive's own frame."""
    closest = "$.archived_snapshots.closest"
    url = F.when(F.get_json_object(body, closest + ".available") == "true", F.get_json_object(body, closest + ".url"))
    return F.regexp_replace(url, "(/web/)([0-9]+)(/)", "$1$2id_$3")
