"""Document intelligence and graph analytics as Spark DataFrame operators."""
