"""Jobs that drain their source and stop."""

from strata.streaming.bronze import run_bronze
from strata.streaming.capture import run_capture
from strata.streaming.publish import run_publish
from strata.streaming.rejects import read_rejects
from strata.streaming.silver import apply_batch, run_silver
from strata.streaming.tail import preview_tail, tail_file_log

__all__ = [
    "apply_batch", "preview_tail", "read_rejects", "run_bronze", "run_capture", "run_publish", "run_silver",
    "tail_file_log",
]
