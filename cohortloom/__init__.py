"""Patient registries on Spark: reusable cohort operators and three registries built from them."""
