"""Names of the registered queries of workload modules given as arguments."""
import importlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
for module in sys.argv[1:]:
    print(" ".join(importlib.import_module(f"packetloom.workload.{module}").QUERIES))
