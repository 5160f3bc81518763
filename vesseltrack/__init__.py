"""vesseltrack: vessel-position (AIS) analytics on Spark DataFrames.

Layers: ``sources`` (file and catalog scans), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps: clean, timeline,
detect, cues, features, iforest, report, quality), ``plans`` (window control,
table writes, the jobs), ``streaming`` (incremental file ingest).
"""

__version__ = "0.1.0"
