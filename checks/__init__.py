"""Independent SQL for checking the registered queries."""
