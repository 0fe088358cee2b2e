"""Layered analytics (stage, clean, consumption) expressed with the Spark DataFrame API."""
