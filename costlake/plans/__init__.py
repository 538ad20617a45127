"""Named queries, their SQL oracles and the pipeline runner."""
