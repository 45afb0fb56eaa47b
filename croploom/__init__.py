"""Farm-parcel and crop analytics as Spark DataFrame jobs."""
