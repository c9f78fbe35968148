"""Named queries, each a composition of operators."""
