"""Community analytics on event bookings, written as Spark jobs."""
