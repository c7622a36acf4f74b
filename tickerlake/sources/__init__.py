"""Sources and sinks: CSV landing, bronze tables, inputs over the driver's tables."""
