"""Table jobs: ``DataFrame -> DataFrame``."""
