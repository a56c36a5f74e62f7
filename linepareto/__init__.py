"""Line-quality analytics on Spark: limit violations, alarms, genealogy, Paretos."""
