"""skywave: HF propagation analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources     typed readers, sinks and the driver-table fixtures
functions   Column expressions (Maidenhead grids, geometry, solar bins, hashing)
operators   DataFrame -> DataFrame operators (signatures, flags, sampling, validation)
plans       named, registered queries built from the operators
streaming   Structured Streaming ingest and incremental rollups
"""

__version__ = "0.1.0"
