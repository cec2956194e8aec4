"""A Spark engine that prepares multilingual text for tokenizer training."""
