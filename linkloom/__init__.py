"""Record-linkage analytics on Spark: declarative blocking, scoring and assignment."""
