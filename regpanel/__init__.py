"""Regional panel analytics on Spark.

Lazy DataFrame operators with R/tidyverse semantics for NULL handling,
joins, reshaping and quantiles, plus the composite panel jobs built from
them.  Every operator returns a DataFrame; nothing is collected to the
driver except small, bounded specification lists.
"""

from regpanel.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
