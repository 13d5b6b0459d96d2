"""seqframe: turn labelled text tables into model-ready sequences on Spark.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column``
function.  The heavy work (splitting, counting, indexing, bucketing, batch
numbering, feature hashing, model fitting) runs as Spark jobs; the driver only
ever sees bounded results (a capped vocabulary, a handful of partition
offsets, a histogram of key prefixes).
"""

from seqframe.session import ensure_checkpoint_dir, get_spark, scratch_dir

__all__ = ["ensure_checkpoint_dir", "get_spark", "scratch_dir"]
