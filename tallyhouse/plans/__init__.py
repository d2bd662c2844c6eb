"""End-to-end job plans: deals job, listings job, publish path, demos."""
