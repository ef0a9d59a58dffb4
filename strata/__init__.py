"""Layered (bronze / silver / gold) pipelines on plain Spark: rescue ingest, typed facts,
Type 2 dimensions and a denormalised order-line mart."""
