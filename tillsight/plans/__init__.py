"""Business reports composed of operators."""
