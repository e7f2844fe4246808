"""Query plans: the panel stand-in, the driver catalogue and the composite jobs."""
