"""Contract checks, curation and detection post-processing for vision data, as Spark queries."""
