"""Session settings and run-time configuration."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Limits of a run; each can be set by an environment variable of the same name in capitals."""

    max_pages_per_source: int = 100
    filter_freshness_hours: int = 24
    max_response_bytes: int = 10 * 1024 * 1024
    request_timeout: int = 30
    requests_per_second: int = 5
    max_attempts: int = 3
    chunk_tokens: int = 6000
    chunk_overlap_tokens: int = 300
    provider_tokens: int = 32000
    provider_output_tokens: int = 4096
    provider_url: str = ""
    provider_model: str = ""
    provider_key: str = ""
    log_level: str = "INFO"
    debug: bool = False

    @classmethod
    def from_env(cls) -> "Settings":
        def read(kind: str, x: str):
            return x if kind == "str" else x.lower() in ("1", "true", "yes") if kind == "bool" else int(x)

        return cls(**{k: read(f.type, os.environ[k.upper()]) for k, f in cls.__dataclass_fields__.items() if k.upper() in os.environ})


def session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """UTC, ANSI, adaptive plans and Arrow; everything else is the cluster's."""
    builder = SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
