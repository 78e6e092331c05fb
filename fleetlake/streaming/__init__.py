"""The batch jobs over newly arriving log files."""
