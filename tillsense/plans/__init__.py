"""Registered query plans: each is (spark, sf_dir) -> DataFrame, with an
equivalent DuckDB SQL text for the correctness oracle."""
