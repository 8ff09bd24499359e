"""tillroll — retail lakehouse analytics (bronze → silver → gold) on PySpark.

Every job is a function ``DataFrame -> DataFrame`` built from Spark SQL /
DataFrame expressions so Catalyst can prune, push down and pick the join and
aggregate strategy.  I/O (file sources, streams, dataset writes) lives at the
edges in :mod:`tillroll.sources` and :mod:`tillroll.streaming`.
"""

from tillroll.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
