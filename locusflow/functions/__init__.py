"""Column-level helpers: CIGAR, base quality, locus formatting."""
