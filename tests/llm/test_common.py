"""What the operators share."""

import subprocess
import sys

import pytest

HELD = """
import re
from linepareto.llm import common

def resident():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024

common.working_on("words")
before = resident()
held = {k: bytes(600) for k in range(400_000)}
last = bytes(600)  # above all others, so that the heap can't shrink by itself
common.working_on("packing", held.clear)
most = resident()
common.working_on("words")
print(before, most, resident())
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_memory_of_another_operator_is_given_back():
    before, most, after = map(int, subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True,
                                                  cwd=__file__.rsplit("/tests/", 1)[0]).stdout.split())
    assert most - before > 200 and after - before < 60
