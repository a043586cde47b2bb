"""Training-data operators: mixing, extraction, fingerprints, language ID,
WARC archives, sharding, similarity joins, packing, quality rules and
substring dedup.  Nothing else in the library imports this subpackage."""
