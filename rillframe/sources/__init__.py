"""What reads files: listings, footers, JSON lines, fingerprints, probes."""
