"""Dataset curation on Spark: fusing, binning, profiling, selecting and cleaning large collections."""
