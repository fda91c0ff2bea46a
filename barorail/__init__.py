"""Rail punctuality, fares, timetables and live trains as Spark DataFrame operators."""
