"""Territorial coverage analytics expressed as Spark DataFrame plans."""
