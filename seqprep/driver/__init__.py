"""The queries registered for the driver, and the SQL they are compared with."""
