import sys
from pathlib import Path

sys.path[:0] = [str(p) for p in Path(__file__).resolve().parents[:2]]
