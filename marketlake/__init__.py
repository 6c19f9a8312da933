"""marketlake: PySpark jobs for auditable market time series."""
