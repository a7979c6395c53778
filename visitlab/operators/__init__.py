"""visitlab.operators."""
