"""Column functions: tag normalisation, time, geometry and tiles. All are built-in expressions; none is a Python UDF."""
