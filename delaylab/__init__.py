"""Flight-delay analytics expressed as plain PySpark DataFrame functions."""
