"""Reading and writing: scans, drift, fingerprints, partitioned tables, audit tables."""
