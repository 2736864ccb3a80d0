"""DataFrame -> DataFrame operators: rules, dedupe, dims, products, quality, recon."""
