"""wardlens: hospital-operations analytics as PySpark DataFrame operators."""
