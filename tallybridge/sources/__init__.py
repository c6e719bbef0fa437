"""Readers: stream records, coordinate ranges, generated calendars, test inputs."""
