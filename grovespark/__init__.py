"""Versioned hierarchical registries on Spark: search, hierarchy, validation, diff, release and geometry as DataFrame plans."""
