"""DataFrame-to-DataFrame operators and the table writers built on them."""

from strata.operators.compact import compact
from strata.operators.envelope import envelope
from strata.operators.gaps import offset_gaps
from strata.operators.latest import latest_per_key
from strata.operators.refine import flatten, record_class, valid
from strata.operators.sse import sse_payloads
from strata.operators.tail import end_offsets, tail_after
from strata.operators.upsert import upsert

__all__ = [
    "compact", "end_offsets", "envelope", "flatten", "latest_per_key", "offset_gaps", "record_class", "sse_payloads", "tail_after", "upsert", "valid",
]
