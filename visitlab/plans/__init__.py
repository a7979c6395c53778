"""visitlab.plans."""
