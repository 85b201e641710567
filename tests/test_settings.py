"""The environment's settings are what the modules work with."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import inspect
from datetime import datetime, timezone
from marlstone.functions import cast
from marlstone.operators import dedup, exposition, metrics
from marlstone.plans import pipelines
from marlstone.sources import feeds
from marlstone.streaming import stateful

def default(f, name):
    return inspect.signature(f).parameters[name].default

print([default(f, "capacity") for f in (dedup.accept_by_memory, stateful.accept_by_memory, pipelines.collect)])
print([default(f, "seconds") for f in (metrics.throughput_now, metrics.rolling_throughput, metrics.sliding_throughput)], metrics.RESET_SECONDS)
print("time_from=20260314T2300" in feeds.news_url("http://h", "k", datetime(2026, 3, 15, 0, 5, tzinfo=timezone.utc)), default(cast.lookback_cutoff, "minutes"), feeds.RECONNECT_SECONDS)
server = exposition.serve(dict)
print(server.server_address[0], default(exposition.serve, "port"))
server.server_close()
print(default(exposition.push, "gateway"), default(exposition.push, "job"))
"""


def test_settings_reach_the_modules():
    env = {"DEDUP_MAXLEN": "7", "THROUGHPUT_WINDOW_SECONDS": "30", "METRICS_RESET_INTERVAL_SECONDS": "600", "NEWS_LOOKBACK_MINUTES": "65", "WS_RECONNECT_DELAY": "9"}
    env |= {"HOST": "127.0.0.2", "PORT": "0", "PUSHGATEWAY_HOST": "g", "PUSHGATEWAY_PORT": "1", "PUSHGATEWAY_JOB_NAME": "j"}
    out = subprocess.run([sys.executable, "-c", CODE], env=os.environ | env | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=60)
    assert out.stdout.splitlines() == ["[7, 7, 7]", "[30, 30, 30] 600", "True 65 9", "127.0.0.2 0", "g:1 j"], out.stderr
