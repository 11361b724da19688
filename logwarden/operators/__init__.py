"""DataFrame-to-DataFrame steps of the analysis."""
