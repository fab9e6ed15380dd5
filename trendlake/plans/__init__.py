"""Jobs and serving queries composed of the operators."""
