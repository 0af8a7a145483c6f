"""The pipeline stages, and the registered queries over the driver tables."""
