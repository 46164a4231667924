"""Sinks: versioned table publish, layer placement, keyed upserts, load audit."""
