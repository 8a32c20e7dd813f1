"""Public-transit analytics on PySpark: schedules, points of interest, roads and live vehicles."""
