"""keyflow: analytics over keyed event streams and tables on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst can prune, push down and plan it.  Operators that
depend on arrival order take explicit ``order`` columns; those that keep
per-key state on live input have a Structured Streaming form in
``keyflow.streaming``.
"""

from keyflow.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
