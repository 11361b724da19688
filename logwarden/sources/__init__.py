"""Reading and writing access logs and alerts."""
