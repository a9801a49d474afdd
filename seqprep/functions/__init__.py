"""Column expressions: no function here starts a job or crosses into Python."""
