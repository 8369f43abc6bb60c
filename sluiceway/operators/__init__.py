"""See the package README for the layout of the engine."""
