"""The command-line entry points parse their arguments."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize(
    "module,flag",
    [
        ("ridepulse.plans.batch_job", "--write-table"),
        ("ridepulse.plans.replay_job", "--rows-per-file"),
        ("ridepulse.streaming.job", "--max-bytes-per-trigger"),
    ],
)
def test_cli_help(module, flag):
    out = subprocess.run(
        [sys.executable, "-m", module, "--help"], cwd=REPO, capture_output=True, text=True, timeout=120
    )
    assert out.returncode == 0, out.stderr
    assert flag in out.stdout
