"""starmart: a healthcare-activity mart expressed as Spark DataFrame jobs."""
