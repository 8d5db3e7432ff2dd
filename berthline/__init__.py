"""berthline: booking-availability and business-metrics data on Spark."""
