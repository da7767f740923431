"""Sources and sinks: scans, data sets, models, metrics."""
