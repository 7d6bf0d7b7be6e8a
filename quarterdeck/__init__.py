"""quarterdeck: equity-fundamentals analytics as Spark DataFrame operators."""
