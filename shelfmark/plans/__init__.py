"""Reports, each a short composition of operators."""
