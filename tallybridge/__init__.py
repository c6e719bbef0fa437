"""Layered payments warehouse on Spark: stream -> RAW -> STG -> DDS -> CDM."""
