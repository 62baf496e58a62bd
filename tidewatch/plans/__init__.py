"""End-to-end compositions of the operators (work on batch and stream frames)."""
