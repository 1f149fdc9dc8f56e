"""quotewell: Spark operators for irregular commodity-price panels."""
