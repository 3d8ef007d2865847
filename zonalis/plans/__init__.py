"""Plan-shaping helpers: materialisation, skew-safe joins, ordered slices, exact quantiles, block kernels."""
