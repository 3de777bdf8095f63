"""Code that Spark runs in workers which can't import this package."""

from __future__ import annotations

import subprocess
import sys

from pyspark import cloudpickle
from pyspark.serializers import CPickleSerializer

from tidegate.streaming import live

LOAD = "import sys; from pyspark.serializers import CPickleSerializer as S; p = S().loads(sys.stdin.buffer.read()); print(type(p).__name__)"


def test_live_processors_load_without_the_package(tmp_path):
    for processor in (live.Delivery(10, 1, None), live.Heartbeats(1, 1)):
        code = cloudpickle.dumps(processor)
        # -I leaves this folder and PYTHONPATH out of the path.
        run = subprocess.run([sys.executable, "-I", "-c", LOAD], input=code, cwd=tmp_path, capture_output=True, timeout=60)
        assert run.stdout.decode().strip() == type(processor).__name__, run.stderr.decode()
        assert type(CPickleSerializer().loads(code)).__name__ == type(processor).__name__
