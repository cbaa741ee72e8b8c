"""Sources and sinks: tables, artifacts, logs, point clouds, meshes, databases and configuration."""
