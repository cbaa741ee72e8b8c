"""fieldspark: sensor, telemetry and spatial analytics on PySpark DataFrames."""
