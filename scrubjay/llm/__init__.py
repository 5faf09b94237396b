"""Training-data operators: near-dedup, mixing, extraction, scanning, sharding,
decontamination, counting and classification over document tables.

Nothing else in the library imports this subpackage."""
