"""Readers, line parsers and writers for the sequencing file formats."""
