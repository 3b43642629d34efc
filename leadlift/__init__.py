"""Lead and propensity scoring as Spark DataFrame operators and batch plans."""
