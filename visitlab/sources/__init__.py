"""visitlab.sources."""
