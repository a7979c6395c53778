"""visitlab.streaming."""
