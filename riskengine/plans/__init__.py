"""End-to-end chains of operators."""
