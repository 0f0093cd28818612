"""Sources, sinks and lineage cuts."""
