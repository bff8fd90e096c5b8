"""lendstrata: credit-risk features, encoding, evaluation and monitoring as Spark DataFrame plans."""
