"""Writers and publication projections."""
