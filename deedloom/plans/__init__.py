"""Plan helpers: session settings, size-checked broadcasts, skew, lineage."""
