"""Access-control badge events on Spark: ingest, dedupe, enrich, monitor.

Every public function takes and returns DataFrames. Times that depend on "now"
take an explicit ``as_of`` so that a result can be reproduced.
"""

from gatelog.session import configure

__all__ = ["configure"]
