"""What runs on executors carries its code; the package need not be there."""

from __future__ import annotations

import os
import subprocess
import sys

from pyspark import cloudpickle

from pageloom.sources.blobs import BlobSink, BlobWriter
from tests.backends import echo_backend


def test_shipped_objects_need_no_package(tmp_path):
    packed = tmp_path / "packed"
    packed.write_bytes(cloudpickle.dumps((echo_backend(), BlobSink, BlobWriter())))
    script = (
        "import pickle, sys\n"
        "make, sink, writer = pickle.load(open('packed', 'rb'))\n"
        "uri = '{\"document\": {\"imageUrl\": \"data:;base64,YWI=\"}}'\n"
        "print(make()(uri), sink.name(), 'pageloom' in sys.modules)"
    )
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert out.stdout.strip() == '{"pages": [{"markdown": "ab"}]} blobs False', out.stderr
