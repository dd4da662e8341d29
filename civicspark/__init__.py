"""Civic finance and voting-record analytics as Spark DataFrame operators."""
