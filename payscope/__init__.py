"""payscope: job-posting analytics as lazy Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from native
Spark expressions.  Column names are passed in through
:class:`payscope.columns.PostingColumns`, so the same operators run on the
raw CSV layout, on snake_case tables, or on any adapter output.
"""

from payscope.columns import RAW, SNAKE, PostingColumns
from payscope.session import build_session, checkpoint_dir

__all__ = ["RAW", "SNAKE", "PostingColumns", "build_session", "checkpoint_dir"]
