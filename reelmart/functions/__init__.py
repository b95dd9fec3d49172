"""Column-level functions: buckets, classifiers, identifiers, measures."""
