"""Regional incident analytics as DataFrame-to-DataFrame functions on Spark."""
