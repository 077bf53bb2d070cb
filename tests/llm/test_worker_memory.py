"""Workers return what they have freed."""

import subprocess
import sys

CODE = """
from offerweave.llm import common

def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096

common.worker_cache("one:texts", lambda: [bytearray(60_000) for _ in range(4_000)])
full = held()
last = bytearray(60_000)  # keeps the end of the heap in use
common.worker_cache("two:none", lambda: None)
assert full - held() > 150_000_000, (full, held())
"""


def test_a_cache_that_goes_leaves_no_memory_behind():
    subprocess.run([sys.executable, "-c", CODE], check=True)
