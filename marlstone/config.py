"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

# The names of the variables.
VARIABLES = {
    "throughput_seconds": "THROUGHPUT_WINDOW_SECONDS",
    "reset_seconds": "METRICS_RESET_INTERVAL_SECONDS",
    "capacity": "DEDUP_MAXLEN",
    "lookback_minutes": "NEWS_LOOKBACK_MINUTES",
    "reconnect_seconds": "WS_RECONNECT_DELAY",
    "host": "HOST",
    "port": "PORT",
    "gateway_host": "PUSHGATEWAY_HOST",
    "gateway_port": "PUSHGATEWAY_PORT",
    "gateway_job": "PUSHGATEWAY_JOB_NAME",
}


@dataclass(frozen=True)
class Settings:
    """Every setting has a default but addresses and secrets, which have none."""

    throughput_seconds: int = 60
    reset_seconds: int = 3600
    capacity: int = 50_000
    lookback_minutes: int = 15
    reconnect_seconds: int = 5
    host: str = "127.0.0.1"
    port: int = 8000
    gateway_host: str = ""
    gateway_port: int = 9091
    gateway_job: str = "news_collector"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        kinds = {f.name: type(f.default) for f in fields(cls)}
        return cls(**{n: kinds[n](env[v]) for n, v in VARIABLES.items() if v in env})

    @property
    def gateway(self) -> str:
        return f"{self.gateway_host}:{self.gateway_port}" if self.gateway_host else ""


#: What the process was started with; the other modules take their defaults from here.
SETTINGS = Settings.from_env()
