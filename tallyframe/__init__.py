"""Request-data warehouse and table operators, written as lazy Spark plans."""
