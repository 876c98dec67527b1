"""Market, portfolio and text-corpus analytics as Spark DataFrame operators."""
