"""gridspark: gridded-field analytics as ordinary Spark DataFrame jobs."""
