"""Stream forms of the batch operators."""
